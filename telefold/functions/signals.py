"""Parallel code/value lists of one frame."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from telefold.functions.clean import java_suffix

#: Stands for a NULL value while a frame is re-keyed, so "sent as NULL" differs from "not sent".
SENT_NULL = "\u0000"

#: Put before a text that must not be read as a number although the JVM would (see ``clean.number``).
TEXT_MARK = "#"

#: Ends each member where a list is handed to a Python worker as one text.
MEMBER_END = "\u001f"

# What the JVM reads as a number, and the words Spark reads beside that.
_JVM_NUMBER = re.compile(
    rb"([+-]?)(?:(NaN)|(Infinity)|((?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
    rb"|(0[xX](?:[0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+))[dDfF]?"
)
_SPARK_WORDS = {
    word: float(word) for word in (b"nan", b"inf", b"+inf", b"infinity", b"+infinity", b"-inf", b"-infinity")
}


def paired(codes: Column, values: Column) -> tuple[Column, Column]:
    """Both lists cut to the shorter one; a NULL list is an empty one."""
    none = F.array().cast("array<string>")
    codes, values = F.coalesce(codes, none), F.coalesce(values.cast("array<string>"), none)
    n = F.least(F.size(codes), F.size(values))
    return F.slice(codes, F.lit(1), n), F.slice(values, F.lit(1), n)


def signal_map(codes: Column, values: Column, first: bool = False) -> Column:
    """Code to value; a repeated code keeps its last value (its first, with ``first``).

    Codes that are NULL become the empty text. Values are kept in a form where a plain ``try_cast`` is
    the right reading of a number; ``sent_text`` gives the text back. The session must keep the last of
    repeated keys (``session.keep_last_key``).
    """
    c, v = paired(codes, values)
    if first:
        c, v = F.reverse(c), F.reverse(v)
    return F.map_from_arrays(
        F.transform(c, lambda x: F.coalesce(x, F.lit(""))), F.transform(v, _kept)
    )


def plain_map(codes: Column, values: Column, first: bool = False) -> Column:
    """``signal_map`` with the values as they were sent, NULL included (``kept_value`` gives their kept form). Codes go through
    a lambda, which isn't compiled, only in a frame that has a NULL or empty one."""
    c, v = paired(codes.cast("array<string>"), values)
    if first:
        c, v = F.reverse(c), F.reverse(v)
    # NULL, not false, if a code is NULL
    clean = F.coalesce(~F.array_contains(c, ""), F.lit(False))
    return F.map_from_arrays(F.when(clean, c).otherwise(F.transform(c, lambda x: F.coalesce(x, F.lit("")))), v)


def kept_value(value: Column, sent_null: Column) -> Column:
    """What ``signal_map`` keeps of a value that was looked up in a ``plain_map``; NULL is one that wasn't sent, or ``sent_null``."""
    marked = java_suffix(value) | value.startswith(TEXT_MARK)
    return F.when(value.isNotNull(), F.when(marked, F.concat(F.lit(TEXT_MARK), value)).otherwise(value)).when(sent_null, SENT_NULL)


def placer(wanted: Sequence[str], first: bool = False) -> Callable[[Column, Column], Column]:
    """Makes of both lists one that holds what was sent of each wanted code, in their order and as ``signal_map`` keeps it,
    or NULL. It works over Arrow batches, where each code sent is looked up once by a hash."""
    wanted = list(wanted)
    null, mark, suffixes = SENT_NULL, TEXT_MARK, list(b"dDfF")

    def place(codes, values):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def bounds(lists):
            edges = np.asarray(lists.offsets)
            sizes = np.where(np.asarray(lists.is_valid()), np.diff(edges), 0)
            return edges[:-1].astype(np.int64) - edges[0], sizes, lists.values.slice(edges[0], edges[-1] - edges[0])

        def kept(texts):
            texts = pc.fill_null(texts, null)
            edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
            if not len(texts) or edges[0] == edges[-1]:
                return texts
            data, some = np.frombuffer(texts.buffers()[2], np.uint8), edges[1:] > edges[:-1]
            start, end = edges[:-1][some], edges[1:][some]
            marked = np.zeros(len(texts), bool)
            marked[some] = np.isin(data[end - 1], suffixes) | (data[start] == ord(mark))
            if not marked.any():
                return texts
            return pc.if_else(pa.array(marked), pc.binary_join_element_wise(pa.scalar(mark), texts, ""), texts)

        width = len(wanted)
        code_at, code_n, code = bounds(codes)
        value_at, value_n, value = bounds(values)
        n = np.minimum(code_n, value_n)
        total = int(n.sum())
        frame = np.repeat(np.arange(len(n)), n)
        inside = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        slots = pc.index_in(pc.fill_null(code, ""), value_set=pa.array(wanted, code.type))
        slots = np.asarray(pc.fill_null(slots, -1))[code_at[frame] + inside]
        known = np.flatnonzero(slots >= 0)
        if first:
            known = known[::-1]
        # of repeated places the last assignment stays
        source = np.full(len(n) * width, -1, np.int64)
        source[frame[known] * width + slots[known]] = (value_at[frame] + inside)[known]
        placed = kept(value).take(pa.array(source, mask=source < 0))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * width, pa.int32()), placed)

    return F.arrow_udf(place, "array<string>")


def number_reader() -> Callable:
    """A function that reads an Arrow array of texts without NULLs as ``clean.number`` does: the numbers, and which texts are
    none (None: all are numbers). Texts of digits, point, minus and exponent, which is nearly all of them, are read by Arrow."""

    def jvm_number(text):
        if text[-1:] in (b"d", b"D", b"f", b"F"):
            return None
        text = text.strip(bytes(range(33)))
        if not (found := _JVM_NUMBER.fullmatch(text)):
            return _SPARK_WORDS.get(text.lower())
        sign, nan, infinity, decimal, hexadecimal = found.groups()
        try:
            size = _SPARK_WORDS[b"nan" if nan else b"inf"] if nan or infinity else float(decimal) if decimal else float.fromhex(hexadecimal.decode())
        except OverflowError:
            size = float("inf")
        return -size if sign == b"-" else size

    def read(texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(texts):
            return np.zeros(0), None
        edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
        if edges[-1] > edges[0]:
            data = memoryview(texts.buffers()[2])[edges[0] : edges[-1]]
            # -./0123456789 are one range of bytes, of which Arrow refuses the slash
            if (np.frombuffer(data, np.uint8) - ord("-")).max() <= ord("9") - ord("-") or not data.tobytes().translate(None, b"0123456789.-eE"):
                try:
                    return np.asarray(pc.cast(texts, pa.float64())), None
                except pa.ArrowInvalid:
                    pass
        # a short one is in a double's range
        plain = pc.match_substring_regex(texts, r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]{1,2})?$")
        plain = np.asarray(pc.and_(plain, pc.less(pc.binary_length(texts), 100)))
        numbers, unreadable = np.zeros(len(texts)), np.zeros(len(texts), bool)
        numbers[plain] = np.asarray(pc.cast(texts.filter(pa.array(plain)), pa.float64()))
        others = texts.filter(pa.array(~plain)).cast(pa.binary()).dictionary_encode()
        found, at = [jvm_number(x) for x in others.dictionary.to_pylist()], np.asarray(others.indices)
        numbers[~plain] = np.array([0.0 if x is None else x for x in found], float)[at]
        unreadable[~plain] = np.array([x is None for x in found], bool)[at]
        return numbers, unreadable

    return read


#: The columns that ``handed`` makes and ``picker`` takes.
HANDED = ("_codes_text", "_values_text", "_odd")


def picker(targets: Sequence[Sequence[tuple[str, float | None]]], first: bool = False, bad: float | None = None) -> Callable[..., Column]:
    """Makes of the columns ``HANDED`` a list with a number for each target: that of its first code that was sent, times the
    code's factor. ``targets`` holds each one's codes by priority. NULL if nothing or NULL was sent; ``bad`` if it can't be read.

    It works over Arrow batches, where each code sent is looked up once by a hash. A list of texts costs a multiple of one text
    on the way there, so lists come as texts.
    """
    wanted = sorted({c for signals in targets for c, _ in signals})
    place = {c: i for i, c in enumerate(wanted)}
    # rounds of a target's number by code: the lowest priority first, so that a higher one overwrites it
    rounds: list[tuple[dict[int, int], dict[int, float]]] = []
    for level in reversed(range(max(map(len, targets), default=0))):
        begun = len(rounds)
        for target, signals in enumerate(targets):
            if level < len(signals):
                code, factor = place[signals[level][0]], signals[level][1]
                free = next((r for r in rounds[begun:] if code not in r[0]), None)
                if free is None:
                    rounds.append(free := ({}, {}))
                free[0][code], free[1][code] = target, 1.0 if factor is None else factor
    width, known = len(targets), range(len(wanted))
    rounds = [([at.get(c, -1) for c in known], [by.get(c, 1.0) for c in known]) for at, by in rounds]
    end, null, read = MEMBER_END, SENT_NULL, number_reader()
    keys = [c + end for c in wanted]

    def pick(codes, values, odd):
        import json

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def members(texts):
            """The members of texts, NULL being none, with their mark, and how many there are in each text."""
            texts = texts.cast(pa.string())
            edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
            data = memoryview(texts.buffers()[2] or b"")[edges[0] : edges[-1]].tobytes()
            ends = np.flatnonzero(np.frombuffer(data, np.uint8) == ord(end))
            offsets = np.zeros(len(ends) + 1, np.int32)
            offsets[1:] = ends + 1
            found = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data))
            return found, np.diff(np.searchsorted(ends, edges - edges[0]))

        def bare(texts):
            """Texts without their mark, which is their last character."""
            edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
            data = memoryview(texts.buffers()[2] or b"")[edges[0] : edges[-1]].tobytes()
            edges = edges - edges[0] - np.arange(len(texts) + 1, dtype=np.int32)
            return pa.StringArray.from_buffers(len(texts), pa.py_buffer(edges), pa.py_buffer(data.translate(None, end.encode())))

        def cut(found, sizes, n):
            """The first ``n`` of each text's members."""
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            return found.take(pa.array(np.repeat(np.cumsum(sizes) - sizes, n) + inside))

        if not len(codes):
            return pa.array([], pa.list_(pa.float64()))
        (code, code_n), (value, value_n) = members(codes), members(values)
        n = np.minimum(code_n, value_n)
        if (code_n != value_n).any():
            code, value = cut(code, code_n, n), cut(value, value_n, n)
        cell, value = np.repeat(np.arange(len(n)) * width, n), bare(value)
        if odd.null_count < len(odd):
            more = [(i, pair) for i, text in enumerate(odd.to_pylist()) if text is not None for pair in zip(*json.loads(text).values())]
            code = pa.concat_arrays([code, pa.array([(c or "") + end for _, (c, _) in more], pa.string())])
            value = pa.concat_arrays([value, pa.array([null if v is None else v for _, (_, v) in more], pa.string())])
            cell = np.concatenate([cell, np.array([i for i, _ in more], np.int64) * width])
        if first:
            code, value, cell = code[::-1], value[::-1], cell[::-1]
        slots = np.asarray(pc.index_in(code, value_set=pa.array(keys, code.type)).fill_null(-1)).astype(np.intp)
        sent = slots >= 0
        if not sent.all():
            value, slots, cell = value.filter(pa.array(sent)), slots[sent], cell[sent]
        numbers, unreadable = read(value)
        valid = None
        if unreadable is not None:
            valid = ~unreadable if bad is None else np.asarray(pc.not_equal(value, null))
        made, there = np.zeros(len(n) * width), np.zeros(len(n) * width, bool)
        # of repeated places the last assignment stays
        for targets_of, factors in rounds:
            target = np.array(targets_of, np.intp).take(slots)
            fed = target >= 0
            if not fed.any():
                continue
            number = numbers * np.array(factors).take(slots)
            if unreadable is not None and bad is not None:
                number[unreadable] = bad
            at = cell + target
            if fed.all():
                made[at] = number
                there[at] = True if valid is None else valid
            else:
                at = at[fed]
                made[at] = number[fed]
                there[at] = True if valid is None else valid[fed]
        bits = pa.py_buffer(np.packbits(there, bitorder="little"))
        made = pa.Array.from_buffers(pa.float64(), len(made), [bits, pa.py_buffer(made)])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * width, pa.int32()), made)

    return F.arrow_udf(pick, "array<double>")


def handed(frames: DataFrame, kept: Sequence[str], codes: str, values: str, lists: bool = False) -> DataFrame:
    """The ``kept`` columns and those that ``picker`` takes: both lists as texts or, where a member holds the mark that ends
    members, as JSON (``_odd``); with ``lists`` also the lists, ``_codes`` and ``_values``.

    The texts are made in a generator over the columns they read. In a projection the optimizer would copy them into the
    arguments of the Python function, which carries along what they are made of.
    """
    both = {"_codes": "", "_values": SENT_NULL}
    none = F.array().cast("array<string>")
    frames = frames.select(*kept, *[F.coalesce(F.col(c).cast("array<string>"), none).alias(x) for x, c in zip(both, (codes, values), strict=True)])
    marked = [F.contains(F.array_join(x, ""), F.lit(MEMBER_END)) for x in both]
    frames = frames.select(*kept, *both, (marked[0] | marked[1]).alias("_odd"))
    texts = [F.when(~F.col("_odd") & (F.size(x) > 0), F.concat(F.array_join(x, MEMBER_END, null), F.lit(MEMBER_END))) for x, null in both.items()]
    made = [*texts, F.when(F.col("_odd"), F.to_json(F.struct(*both)))]
    made = [c.alias(x) for c, x in zip(made, HANDED, strict=True)]
    return frames.select(*kept, F.inline(F.array(F.struct(*made, *(both if lists else ())))))


def _kept(x: Column) -> Column:
    marked = java_suffix(x) | x.startswith(TEXT_MARK)
    return F.when(x.isNull(), SENT_NULL).when(marked, F.concat(F.lit(TEXT_MARK), x)).otherwise(x)


def sent_text(kept: Column) -> Column:
    """The text behind a ``signal_map`` entry."""
    plain = F.when(kept.startswith(TEXT_MARK), F.substr(kept, F.lit(2))).otherwise(kept)
    return F.when(kept != SENT_NULL, plain)


def quoted(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace(SENT_NULL, "\\u0000") + "'"


def sent_text_sql(kept: str) -> str:
    """``sent_text`` of a SQL expression."""
    null, mark = quoted(SENT_NULL), quoted(TEXT_MARK)
    return f"IF({kept} <> {null}, IF(startswith({kept}, {mark}), substr({kept}, 2), {kept}), NULL)"


def sent_number_sql(kept: str) -> str:
    """``sent_number`` of a SQL expression."""
    return f"try_cast({kept} AS DOUBLE)"


def sent_number(kept: Column) -> Column:
    """The number behind a ``signal_map`` entry, NULL when there is none."""
    return kept.try_cast("double")


def item_map(items: Column, key: str, value: str) -> Column:
    """A list of ``{key, value}`` structs as a map; entries without a key are left out."""
    named = F.filter(items, lambda x: x.getField(key).isNotNull())
    return F.map_from_entries(
        F.transform(named, lambda x: F.struct(x.getField(key), x.getField(value)))
    )


def pluck(items: Column, field: str) -> Column:
    """One field of every struct in a list."""
    return F.transform(items, lambda x: x.getField(field))


def only_known(signals: Column, known: Sequence[str]) -> Column:
    """The entries of a signal map whose code is configured."""
    return F.map_filter(signals, lambda code, _: code.isin(*known))


def value_at(codes: Column, values: Column, code: str) -> Column:
    """The value at the first position of a code, NULL when absent or beyond the value list."""
    at = F.array_position(codes, code)
    return F.when(at > 0, F.try_element_at(values, at.cast("int")))
