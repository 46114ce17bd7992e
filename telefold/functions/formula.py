"""Formula columns: ``{a} / ({b} * (273 + {c}))`` over fused targets."""

from __future__ import annotations

import ast
import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

_NAME = re.compile(r"\{(.*?)\}")

_BINARY: dict[type, Callable[[Column, Column], Column]] = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: lambda a, b: F.try_divide(a, b),
    ast.Pow: lambda a, b: F.pow(a, b),
}


def operands(formula: str) -> list[str]:
    """Target names a formula reads, in order of appearance."""
    return list(dict.fromkeys(_NAME.findall(formula)))


def compile_formula(formula: str, column: Callable[[str], Column]) -> Column:
    """A formula as one Column; only numbers, ``{name}`` and ``+ - * / ** ( )`` are accepted."""
    names = operands(formula)
    spelled = _NAME.sub(lambda m: f" v{names.index(m.group(1))} ", formula)
    try:
        tree = ast.parse(spelled.strip(), mode="eval").body
    except SyntaxError as error:
        raise ValueError(f"not a formula: {formula!r}") from error

    def build(node: ast.expr) -> Column:
        if isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
            return _BINARY[type(node.op)](build(node.left), build(node.right))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -build(node.operand)
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.UAdd):
            return build(node.operand)
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            return F.lit(float(node.value))
        if isinstance(node, ast.Name) and node.id.startswith("v") and node.id[1:].isdigit():
            return F.round(column(names[int(node.id[1:])]), 3)
        raise ValueError(f"not allowed in a formula: {formula!r}")

    return build(tree)


def formula_value(
    formula: str,
    column: Callable[[str], Column],
    low: float | None,
    high: float | None,
    default: float | None,
) -> Column:
    """The formula's value, or the default when an operand is NULL, a division is by zero, the result
    is not finite or it leaves the range."""
    value = compile_formula(formula, column)
    fine = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    if low is not None:
        fine = fine & (value >= F.lit(float(low)))
    if high is not None:
        fine = fine & (value <= F.lit(float(high)))
    return F.when(fine, value).otherwise(F.lit(default).cast("double"))
