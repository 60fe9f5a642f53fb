"""Fill-in-the-middle: documents cut at two ranks of units and put in another order around control strings.

A text is cut into units by a pattern matched left to right (code points by default; words, lines or any
other pattern). An indexable skip list is laid over the units: the lanes above the bottom one skip over ever more
units, and every link of every lane carries two widths, the units and the code points it passes. To
reach a rank, the search goes along the top lane while the accumulated units stay at or below it, then
one lane down, and so on; the code points gathered on the way are the exact place of the cut, for units of any
length, after at most 31 links per lane. Which links stand in the next lane is a fixed hash of their number, so a
rerun builds the same list.

`1:` and the key give the draws of a document (SHA-256): two cut ranks, whether it is transformed, and which of
the two orders it takes. The three forms are

    plain   the text
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

Texts that hold a control string stay plain, so that `restored` is exact for every output.

Work is per row in Arrow batches, no shuffle. A lane is an array with one entry per link, so memory
is that of a batch of texts and one list.

Defined cases: a null or empty text is plain with no units; a null key draws as the empty string; repeated rows
give repeated results; code points between matches of the pattern belong to the unit before them, those before
the first match to the first unit, and a text without a match is one unit; an empty table gives an empty result;
further columns are left alone and not returned.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_text, named, text_or_empty
from .rows import by_batch

PREFIX, SUFFIX, MIDDLE = CONTROLS = ("<P>", "<S>", "<M>")
CODE_POINT = r"[\s\S]"
STRIDE = 16  # links of a lane to one of the next; `_tall` draws four bits
MIX = np.uint64(0x9E3779B97F4A7C15)


def unit_lengths(text: str, pattern: str = CODE_POINT) -> np.ndarray:
    """Code points of each unit."""
    if pattern == CODE_POINT or not text:
        return np.broadcast_to(np.int64(1), len(text))  # takes no memory
    starts = [m.start() for m in re.finditer(pattern, text) if m.end() > m.start()]
    starts[:1] = [0]
    return np.diff(np.array([*starts, len(text)], np.int64))


class SkipList:
    """Lanes of links over units; a link has the units and the code points it passes, and its place in the lane below."""

    def __init__(self, lengths: np.ndarray):
        units, points = np.broadcast_to(np.int64(1), len(lengths)), lengths
        self.lanes = [(units, points, range(len(lengths) + 1))]
        while len(units) > STRIDE:
            tall = self._tall(len(units), len(self.lanes))
            below = np.append(tall, len(units))
            units, points = np.add.reduceat(units, tall), np.add.reduceat(points, tall)
            self.lanes.append((units, points, below))

    @staticmethod
    def _tall(links: int, lane: int) -> np.ndarray:
        """The links that the next lane starts from: the first, and of each STRIDE in a row one by a hash."""
        block = np.arange(0, links, STRIDE, dtype=np.uint64)
        drawn = block + ((block + np.uint64(lane)) * MIX >> np.uint64(60))
        drawn[0] = 0
        return drawn[drawn < links].astype(np.int64)

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank (the number of units: the end)."""
        passed = points = at = 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, widths, below = self.lanes[lane]
            while at < len(units) and passed + units[at] <= rank:
                passed, points, at = passed + int(units[at]), points + int(widths[at]), at + 1
            at = int(below[at])
        return points


def draws(key: str) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers that depend on the key alone."""
    digest = hashlib.sha256(f"1:{key}".encode("utf-8", "surrogatepass")).digest()
    return tuple(int.from_bytes(digest[4 * n:4 * n + 4], "big") for n in range(4))


def arranged(text: str, cuts: tuple[int, int], form: str) -> str:
    if form == "plain":
        return text
    prefix, middle, suffix = text[:cuts[0]], text[cuts[0]:cuts[1]], text[cuts[1]:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def transformed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", pattern: str = CODE_POINT, percent: int = 90, spm_percent: int = 20,
) -> DataFrame:
    """Per row: key, `n` units, `form`, `prefix_chars` and `middle_chars` (null if plain), `output`.

    `percent` of the texts are transformed, `spm_percent` of these with the suffix first. The
    prefix and the middle together hold whole units.
    """
    def make(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("n", "form", "prefix_chars", "middle_chars", "output")}
        for name, body in zip(batch["name"], batch["text"]):
            lengths = unit_lengths(body, pattern)
            h1, h2, h3, h4 = draws(name)
            form, low, high = "plain", None, None
            if body and h3 % 100 < percent and not any(c in body for c in CONTROLS):
                form, lanes = "spm" if h4 % 100 < spm_percent else "psm", SkipList(lengths)
                low, high = sorted(lanes.place(h % (len(lengths) + 1)) for h in (h1, h2))
            out["n"].append(len(lengths))
            out["form"].append(form)
            out["prefix_chars"].append(low)
            out["middle_chars"].append(None if low is None else high - low)
            out["output"].append(arranged(body, (low, high), form))
        return {"doc": batch["doc"], **out}
    rows = docs.select(named(key).alias("doc"), key_text(key).alias("name"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    made = by_batch(rows, make, f"doc {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("doc", key)


def restored(rows: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """`rows` with the text rebuilt from output and form, by built-in functions; null where the output lacks its marks."""
    body, kind = F.col(output), F.col(form)
    first = F.when(kind == "psm", PREFIX).otherwise(SUFFIX)
    second = F.when(kind == "psm", SUFFIX).otherwise(PREFIX)
    opened = body.startswith(first) & body.contains(second) & body.contains(MIDDLE)
    rest = F.substr(body, F.length(first) + 1)
    middle = F.substr(rest, F.locate(MIDDLE, rest) + len(MIDDLE))
    head = F.substr(rest, F.lit(1), F.locate(MIDDLE, rest) - 1)
    one = F.substr(head, F.lit(1), F.position(second, head) - 1)
    two = F.substr(head, F.position(second, head) + F.length(second))
    whole = F.when(kind == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return rows.withColumn(name, F.when(kind == "plain", body).when(opened, whole))
