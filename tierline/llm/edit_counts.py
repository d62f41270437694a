"""Token counts that follow edits without counting a text again (operator 9).

A text is cut into leaves of a few hundred characters, at places where the tokenizer
always cuts: before a single space between two other characters. A tree over the leaves
holds the token sum of every subtree in one flat array. An edit touches a run of leaves;
those are encoded again together with one leaf on either side that holds text, because a
cut is only certain while the characters around it stay. Their new count goes to the first of them,
the others become empty, and only the sums above them change.

Defined results: a null text is an empty one; null or empty edits leave a count as it is;
edits are given in places of the text before any of them, must not overlap, and are
clipped to the text; repeated rows are counted each for itself; a text without any such
place is one leaf, so that any edit encodes all of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import map_rows
from tierline.llm.tokens import SPACE, Encoder, encoder

LEAF_CHARS = 400
CUT = re.compile(f"(?<=[^{SPACE}])(?= [^{SPACE}])")

Edit = tuple[int, int, str]


def leaves_of(text: str) -> list[int]:
    """Lengths of the leaves of ``text``."""
    ends, at = [], 0
    while (m := CUT.search(text, at + LEAF_CHARS)) is not None:
        ends.append(m.start())
        at = m.start()
    ends.append(len(text))
    return [b - a for a, b in zip([0, *ends], ends)]


class TokenTree:
    """Leaves and subtree sums; ``sums[1]`` counts the whole text."""

    def __init__(self, lengths: Sequence[int], sums: Sequence[int]) -> None:
        self.lengths = list(lengths)
        self.sums = list(sums)
        self.width = len(self.sums) // 2

    @classmethod
    def of(cls, text: str, counter: Encoder) -> TokenTree:
        lengths = leaves_of(text)
        width = 1 << (len(lengths) - 1).bit_length()
        sums, at = [0] * (2 * width), 0
        for k, n in enumerate(lengths):
            sums[width + k] = counter.count(text[at : at + n])
            at += n
        for k in range(width - 1, 0, -1):
            sums[k] = sums[2 * k] + sums[2 * k + 1]
        return cls(lengths, sums)

    @property
    def total(self) -> int:
        return self.sums[1]

    def set(self, leaf: int, tokens: int) -> None:
        k = self.width + leaf
        change = tokens - self.sums[k]
        while change and k:
            self.sums[k] += change
            k //= 2

    def edit(self, text: str, edits: Sequence[Edit], counter: Encoder) -> tuple[str, int]:
        """Apply ``edits`` to ``text``; the new text, and the characters encoded again."""
        todo = sorted((max(0, min(a, len(text))), max(0, min(b, len(text))), c or "") for a, b, c in edits)
        ends, at = [], 0
        for n in self.lengths:
            at += n
            ends.append(at)
        runs: list[list] = []  # first leaf, last leaf, edits
        for start, stop, new in todo:
            first = self._leaf(ends, start)
            last = self._leaf(ends, max(start, stop))
            first, last = self._beside(first, -1), self._beside(last, 1)
            if runs and first <= runs[-1][1] + 1:
                runs[-1][1] = max(last, runs[-1][1])
                runs[-1][2].append((start, stop, new))
            else:
                runs.append([first, last, [(start, stop, new)]])
        out, at, encoded = [], 0, 0
        for first, last, own in runs:
            low = ends[first - 1] if first else 0
            out.append(text[at:low])
            part, at = [], low
            for start, stop, new in own:
                part += [text[at : max(at, start)], new]
                at = max(at, stop)
            part.append(text[at : ends[last]])
            at = ends[last]
            fresh = "".join(part)
            encoded += len(fresh)
            out.append(fresh)
            self.set(first, counter.count(fresh))
            self.lengths[first] = len(fresh)
            for leaf in range(first + 1, last + 1):
                self.set(leaf, 0)
                self.lengths[leaf] = 0
        out.append(text[at:])
        return "".join(out), encoded

    def _beside(self, leaf: int, way: int) -> int:
        """The next leaf that holds text, or the outermost one; earlier edits leave empty ones."""
        at = leaf + way
        while 0 < at < len(self.lengths) - 1 and not self.lengths[at]:
            at += way
        return min(max(at, 0), len(self.lengths) - 1)

    @staticmethod
    def _leaf(ends: list[int], place: int) -> int:
        low, high = 0, len(ends) - 1
        while low < high:
            middle = (low + high) // 2
            if ends[middle] > place:
                high = middle
            else:
                low = middle + 1
        return low


def build_trees(
    docs: DataFrame, vocabulary: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``text`` and its tree; write it, edits are counted against it."""

    def row(counter: Encoder, doc_id: int | None, text: str | None) -> Iterator[tuple]:
        text = text or ""
        tree = TokenTree.of(text, counter)
        yield doc_id, text, tree.lengths, tree.sums

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(
        slim,
        slim.columns,
        row,
        "doc_id long, text string, lengths array<int>, sums array<long>",
        lambda: encoder(vocabulary, True, False),
    )


def count_after(trees: DataFrame, edits: Column, vocabulary: str, *, with_trees: bool = False) -> DataFrame:
    """Token counts before and after ``edits``, an array of (start, stop, text) per row.

    Returns ``doc_id, n_tokens, n_tokens_after, n_encoded``: the last is how many
    characters were encoded again. ``with_trees`` adds the edited ``text`` and its tree,
    ``lengths`` and ``sums``, on which later edits can build.
    """

    def row(counter: Encoder, doc_id, text, lengths, sums, edits) -> Iterator[tuple]:
        tree = TokenTree(lengths, sums)
        before = tree.total
        todo = [tuple(e.values()) for e in edits or () if e]
        after, encoded = tree.edit(text, todo, counter)
        own = (after, tree.lengths, tree.sums) if with_trees else ()
        yield doc_id, before, tree.total, encoded, *own

    given = trees.withColumn("edits", edits)
    return map_rows(
        given,
        ["doc_id", "text", "lengths", "sums", "edits"],
        row,
        "doc_id long, n_tokens long, n_tokens_after long, n_encoded long"
        + (", text string, lengths array<int>, sums array<long>" if with_trees else ""),
        lambda: encoder(vocabulary, True, False),
    )


def sample_edits(text: str = "text") -> Column:
    """Three edits made from a text itself: a replaced, a removed and an added passage."""
    n = F.length(text)

    def edit(start: Column, stop: Column, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"), new.alias("new"))

    third, half = F.floor(n / 3), F.floor(n / 2)
    return F.array(
        edit(third, F.least(third + 12, half), F.substring(F.col(text), 1, 20)),
        edit(half, F.least(half + 9, n), F.lit("")),
        edit(n, n, F.concat(F.lit(" "), F.reverse(F.substring(F.col(text), 1, 30)))),
    )
