"""Fill-in-the-middle: documents cut in three at places counted in units, the middle moved to the end.

Units are runs of letters and single other characters. A text's units are counted chunk by chunk: a rolling hash of
the last ``SPAN`` code points ends a chunk, so equal passages fall into equal chunks wherever they stand. What a chunk
adds is remembered by its content, compared as a whole: its units, and whether it begins and ends inside letters. Two
neighbours share a unit if one ends and the next begins with a letter. The sums over the chunks give the document's
units and say in which chunk a cut lies; only that chunk is looked into.

Null and empty texts are ``plain`` with 0 units and an empty output; a null key counts as an empty one. Equal rows give
equal results. Very long texts are hashed in blocks of ``AT_ONCE`` code points. Other columns are kept whatever their
names; a column that already has an output's name is replaced. Map-only.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import named, unused
from .held import held, tidy
from .vocab import Remembered

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SPAN = 16  # code points that the rolling hash sees; a power of two
LEAST, MOST = 64, 2_048  # code points of a chunk; the last may be shorter
RARE = 56  # a chunk ends where the hash's bits from here on are 0: one place in 256
AT_ONCE = 1 << 18
FACTOR = 0x9E3779B97F4A7C15  # any odd number with mixed bits


def _hashes(codes: np.ndarray) -> np.ndarray:
    """For each place the hash of the last SPAN code points: a polynomial modulo 2^64, by doubling its length."""
    h, factor, width = codes.astype(np.uint64) * np.uint64(FACTOR), FACTOR, 1
    h ^= h >> np.uint64(29)
    while width < SPAN:
        longer = h.copy()
        longer[width:] += h[:-width] * np.uint64(factor)
        h, factor, width = longer, factor * factor % 2**64, 2 * width
    return h


def chunk_ends(text: str) -> list[int]:
    """Where the chunks of a text that isn't empty end, in code points."""
    n = len(text)
    if n <= LEAST:
        return [n]
    codes, found = np.frombuffer(text.encode("utf-32-le"), np.uint32), []
    for at in range(0, n, AT_ONCE):
        before = min(at, SPAN - 1)
        h = _hashes(codes[at - before:at + AT_ONCE])[before:]
        found.append(np.flatnonzero(h >> np.uint64(RARE) == 0) + (at + 1))
    places, ends, last, i = np.concatenate(found), [], 0, 0
    while n - last > LEAST:
        i = int(np.searchsorted(places, last + LEAST))
        last = min(n, last + MOST, int(places[i]) if i < len(places) else n)
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def summary(chunk: str) -> tuple[int, bool, bool]:
    """A chunk's units, and whether its first and its last character are letters."""
    return len(UNIT.findall(chunk)), _letter(chunk[0]), _letter(chunk[-1])


@held
def _summaries() -> Remembered:
    return Remembered(summary, 20_000)


class Units:
    """A text's units, from its chunks' summaries."""

    def __init__(self, text: str, summaries: dict[str, tuple[int, bool, bool]]):
        self.text, self.ends = text, chunk_ends(text) if text else []
        self.begun: list[int] = []  # units begun up to each chunk's end
        self.joined: list[bool] = []  # whether a chunk's first unit began before it
        n, inside, at = 0, False, 0
        for end in self.ends:
            units, first, last = summaries[text[at:end]]
            self.joined.append(inside and first)
            n += units - (inside and first)
            self.begun.append(n)
            inside, at = last, end
        self.n = n

    def place(self, units: int) -> int:
        """Code points of the first so many units."""
        if units >= self.n:
            return len(self.text)
        i = bisect_right(self.begun, units)  # the next unit begins in this chunk
        at = self.ends[i - 1] if i else 0
        nth = units - (self.begun[i - 1] if i else 0) + self.joined[i]
        return at + next(islice(UNIT.finditer(self.text[at:self.ends[i]]), nth, None)).start()


def _draw(key: Column, seed: int, nth: int) -> Column:
    """The nth 8-digit group of the hex digest of seed and key, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * nth - 7, 8), 16, 10).cast("long")


@tidy
def _cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """A text's units, and the code points before its middle and up to the middle's end."""
    summaries = _summaries()
    for texts, ones, twos in batches:
        rows = []
        for text, a, b in zip(texts, ones.to_pylist(), twos.to_pylist()):
            units = Units(text.as_py() or "", summaries)
            first, second = sorted((a % (units.n + 1), b % (units.n + 1)))
            rows.append((units.n, units.place(first), units.place(second)))
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = ("n", pa.int64()), ("first", pa.int32()), ("second", pa.int32())
        yield pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [name for name, _ in kinds])


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90, suffix_first: int = 20
) -> DataFrame:
    """Adds ``n long`` (units), ``form string``, ``prefix_chars int``, ``middle_chars int`` (NULL if plain) and
    ``output string``.

    ``percent`` of the documents are transformed, ``suffix_first`` percent of them as ``spm``, the others as ``psm``;
    texts that are empty or hold a mark stay ``plain``. Cuts and forms follow from seed and key alone.
    """
    cut, body = unused(docs, "cut"), F.coalesce(named(text), F.lit(""))
    draws = [_draw(named(key), seed, i) for i in range(1, 5)]
    cuts = F.arrow_udf(_cuts, "struct<n:long,first:int,second:int>")
    both = docs.withColumn(cut, cuts(named(text), draws[0], draws[1]))
    at = named(cut)
    marked = functools.reduce(Column.__or__, [F.contains(body, F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)])
    plain = (body == "") | marked | (draws[2] % 100 >= percent)
    form = F.when(plain, "plain").when(draws[3] % 100 < suffix_first, "spm").otherwise("psm")
    before = F.substring(body, F.lit(1), at["first"])
    middle = F.substring(body, at["first"] + 1, at["second"] - at["first"])
    after = F.substring(body, at["second"] + 1, F.char_length(body))
    psm = F.concat(F.lit(PREFIX), before, F.lit(SUFFIX), after, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), after, F.lit(PREFIX), before, F.lit(MIDDLE), middle)
    made = {
        "n": at["n"],
        "form": form,
        "prefix_chars": F.when(~plain, at["first"]),
        "middle_chars": F.when(~plain, at["second"] - at["first"]),
        "output": F.when(plain, body).when(draws[3] % 100 < suffix_first, spm).otherwise(psm),
    }
    return both.select(*(named(c) for c in docs.columns if c.lower() not in made), *(c.alias(name) for name, c in made.items()))


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made an output of. Marks stand in an output only where it put them."""
    rest = F.substr(output, F.lit(len(PREFIX) + 1))

    def between(first: str, last: str) -> Column:
        """prefix and suffix stand first and second in either form"""
        return F.split_part(F.split_part(rest, F.lit(first), F.lit(2)), F.lit(last), F.lit(1))

    middle = F.split_part(rest, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(F.split_part(rest, F.lit(SUFFIX), F.lit(1)), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, F.split_part(rest, F.lit(PREFIX), F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
