"""Alignment of two tokenizers' ids over the same bytes (operator 13).

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B) that puts
a space in front; A gets the same space. Where tokens of both end at one byte offset, a
group ends. The groups are found by diagonal run skipping: from a common end, at the
current shift between the two indices, both arrays of ends are compared over stretches of
1, 2, 4, ... tokens, and equal stretches are jumped as one-to-one groups. Where they
differ, the group is closed by stepping the side that is behind, which sets the new
shift. The steps are also the links: each pairs tokens whose byte ranges overlap.

Long texts are aligned in windows that end at a common end, so memory holds their ids and
one window of working lists. Pair counts and the sums over them are Spark aggregations; a
pair that occurs in nearly every document is summed up per task before it is shuffled,
and adaptive execution splits it where the counts are joined back.

Defined results: null and empty texts, and texts whose bytes one of the vocabularies does
not give back, have no tokens and zeros; strings of special tokens are plain text; rows are
documents, so repeated rows and ids count one by one; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import map_rows
from tierline.llm.tokens import ALPHABET

WINDOW = 1 << 15
SPACE_MARK = "▁"


class Vocabulary:
    """Ids of a text with the bytes, their number and the decimal name of every id."""

    def __init__(self, entries: list[bytes]) -> None:
        self.entries = entries
        self.sizes = np.array([len(e) for e in entries], dtype=np.int64)
        self.names = [str(i) for i in range(len(entries))]

    def text(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids.tolist()))


def byte_entries(vocabulary: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary file."""
    with open(vocabulary, encoding="utf-8") as file:
        found = json.load(file)
    back = {letter: byte for byte, letter in ALPHABET.items()}
    ids = dict(found["model"]["vocab"])
    ids |= {content: at for at, content in _added(found).items()}
    entries = [b""] * (max(ids.values()) + 1)
    for entry, at in ids.items():
        entries[at] = bytes(back[c] if c in back else ord(c) for c in entry)
    return entries


def piece_entries(model) -> list[bytes]:
    def entry(at: int) -> bytes:
        piece = model.id_to_piece(at)
        if model.is_byte(at):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    return [entry(at) for at in range(model.get_piece_size())]


# How many names of pairs and groups are remembered, and of groups how long ones.
PAIR_NAMES, GROUPS, LONG_GROUP = 1 << 17, 1 << 16, 16


def byte_encoding(vocabulary: str, entries: list[bytes]):
    """The vocabulary file for the ``tiktoken`` library, which encodes the same ids faster.

    It joins the pair of least rank first and takes ids for ranks, which is right where the
    file lists its merges in the order of the ids they make; anything else is refused.
    """
    import public_tokenizers
    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        found = json.load(file)
    vocab = found["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in found["model"]["merges"]]
    made = [vocab["".join(m)] for m in merges]
    if made != sorted(made) or len({e for e in entries if len(e) == 1}) < 256:
        raise ValueError("not a byte-level vocabulary in the order of its merges")
    ranks = {entries[at]: at for at in vocab.values() if at not in _added(found)}
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _added(found: dict) -> dict[int, str]:
    return {added["id"]: added["content"] for added in found.get("added_tokens", [])}


class Tokenizers:
    """Both vocabularies of one task."""

    def __init__(self, byte_vocabulary: str, piece_model: str) -> None:
        import sentencepiece

        self.a = Vocabulary(byte_entries(byte_vocabulary))
        self.encoding = byte_encoding(byte_vocabulary, self.a.entries)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        self.b = Vocabulary(piece_entries(self.pieces))
        self.pair_names = _PairNames()
        self.irregular = _Irregular(self.a, self.b)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``text`` in both; none where their bytes are not those of the text.

        Special tokens are in neither vocabulary here, so their strings are plain text.
        """
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        spaced = " " + text
        b = np.array(self.pieces.encode(text, num_threads=1), dtype=np.int64)
        wanted = spaced.encode()
        if self.b.text(b) != wanted:
            return none, none
        a = np.array(self.encoding.encode_ordinary(spaced), dtype=np.int64)
        # A gives back every byte; the sum of sizes would show if it did not.
        if self.a.sizes[a].sum() != len(wanted):
            return none, none
        return a, b


class _PairNames(dict):
    """``a << 32 | b`` to ``'a|b'``; emptied when full."""

    def __missing__(self, pair: int) -> str:
        if len(self) >= PAIR_NAMES:
            self.clear()
        self[pair] = name = f"{pair >> 32}|{pair & 0xFFFFFFFF}"
        return name


class _Irregular(dict):
    """A group's ids in A and B, as tuples, to its name and its links; emptied when full."""

    def __init__(self, a: Vocabulary, b: Vocabulary) -> None:
        super().__init__()
        self.a, self.b = a, b

    def __missing__(self, group: tuple[tuple[int, ...], tuple[int, ...]]) -> tuple[str, list[int]]:
        a, b = group
        name = ",".join([self.a.names[x] for x in a]) + "|" + ",".join([self.b.names[x] for x in b])
        ends = (np.cumsum(v.sizes[list(ids)]).tolist() for v, ids in ((self.a, a), (self.b, b)))
        links = [a[x] << 32 | b[y] for x, y in zip(*_links(*ends))]
        if len(a) + len(b) <= LONG_GROUP:
            if len(self) >= GROUPS:
                self.clear()
            self[group] = name, links
        return name, links


def runs(a: list[int], b: list[int]) -> list[int]:
    """Stretches of two arrays of ends that start at one offset, five numbers after another.

    ``i, j, n, p, q``: ``n`` one-to-one groups from ``a[i]`` and ``b[j]`` on, then, unless
    ``p == i + n``, a group of several tokens that ends before ``a[p]`` and ``b[q]``. A
    group that an array does not close is left out.
    """
    found: list[int] = []
    i = j = 0
    last_a, last_b = len(a), len(b)
    while i < last_a and j < last_b:
        # Probe ahead on this diagonal with stretches that double while they agree.
        p, q, step = i, j, 4
        while True:
            left, right = a[p : p + step], b[q : q + step]
            if left == right and len(left) == step:
                p += step
                q += step
                step *= 2
                continue
            for x, y in zip(left, right):
                if x != y:
                    break
                p += 1
                q += 1
            break
        n = p - i
        if p < last_a and q < last_b:
            # Close the group that differs by stepping the side that is behind.
            x, y = a[p], b[q]
            while x != y:
                if x < y:
                    p += 1
                    if p == last_a:
                        break
                    x = a[p]
                else:
                    q += 1
                    if q == last_b:
                        break
                    y = b[q]
            if x == y:
                p += 1
                q += 1
                found += (i, j, n, p, q)
                i, j = p, q
                continue
        if n:
            found += (i, j, n, i + n, j + n)
        break
    return found


def groups(a_ends: np.ndarray, b_ends: np.ndarray, window: int = WINDOW) -> Iterator[np.ndarray]:
    """:func:`runs` of whole arrays, window by window, a row each, with indices into the arrays."""
    i = j = 0
    size = window
    while i < len(a_ends):
        found = runs(a_ends[i : i + size].tolist(), b_ends[j : j + size].tolist())
        if not found:
            size *= 2
            continue
        rows = np.array(found, dtype=np.int64).reshape(-1, 5) + [i, j, 0, i, j]
        yield rows
        (i, j), size = rows[-1, 3:].tolist(), window


def _links(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], list[int]]:
    """Places of overlapping tokens in one group."""
    i = j = 0
    left, right = [0], [0]
    while i < len(a_ends) - 1 or j < len(b_ends) - 1:
        if a_ends[i] < b_ends[j]:
            i += 1
        else:
            j += 1
        left.append(i)
        right.append(j)
    return left, right


def align(a: np.ndarray, b: np.ndarray, tokenizers: Tokenizers) -> tuple[int, int, str, np.ndarray, np.ndarray]:
    """Number of groups and links, the groups' digest, linked id pairs and how often each occurs.

    A pair is ``a << 32 | b``.
    """
    a_ends, b_ends = np.cumsum(tokenizers.a.sizes[a]), np.cumsum(tokenizers.b.sizes[b])
    pair_name, irregular = tokenizers.pair_names.__getitem__, tokenizers.irregular
    digest, n_groups, n_links = hashlib.sha256(), 0, 0
    pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for found in groups(a_ends, b_ends):
        i, j, size, _, _ = found.T
        at = np.repeat(i - np.cumsum(size) + size, size) + np.arange(size.sum())
        linked = a[at] << 32 | b[at + np.repeat(j - i, size)]
        names = list(map(pair_name, linked.tolist()))
        (first, start), (last, stop) = found[0, :2], found[-1, 3:]
        la, lb = a[first:last].tolist(), b[start:stop].tolist()
        parts, more, done = [], [], 0
        for i, j, n, p, q in (found - [first, start, 0, first, start]).tolist():
            if n:
                parts += names[done : done + n]
                done += n
            if p > i + n:
                name, links = irregular[tuple(la[i + n : p]), tuple(lb[j + n : q])]
                parts.append(name)
                more += links
        digest.update((";" if n_groups else "").encode() + ";".join(parts).encode())
        n_groups += len(parts)
        n_links += len(linked) + len(more)
        some, often = np.unique(np.concatenate([linked, np.array(more, dtype=np.int64)]), return_counts=True)
        if len(pairs):
            both, at = np.unique(np.concatenate([pairs, some]), return_inverse=True)
            summed = np.zeros(len(both), np.int64)
            np.add.at(summed, at, np.concatenate([times, often]))
            pairs, times = both, summed
        else:
            pairs, times = some, often
    return n_groups, n_links, digest.hexdigest() if n_groups else "", pairs, times


def align_texts(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document its counts, digest, distinct id pairs and how often each is linked."""

    def row(tokenizers: Tokenizers, doc_id: int | None, text: str | None) -> Iterator[tuple]:
        a, b = tokenizers.encode(text)
        n_groups, n_links, digest, pairs, times = align(a, b, tokenizers)
        yield doc_id, len(a), len(b), n_groups, n_links, digest, pairs.tolist(), times.tolist()

    slim = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text")
    )
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<int>"
    )
    return map_rows(
        slim, slim.columns, row, schema, start=lambda: Tokenizers(byte_vocabulary, piece_model), slice_rows=128
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n_docs``: how many documents hold each id pair linked."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))


def align_tokenizers(
    docs: DataFrame,
    store,
    byte_vocabulary: str,
    piece_model: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    aligned = align_texts(docs, byte_vocabulary, piece_model, id_column=id_column, text_column=text_column)
    aligned = store.keep(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = store.keep(pair_counts(aligned), "pair-counts")
    a_id = F.shiftright("pair", 32).alias("a_id")
    most = counts.groupBy(a_id).agg(F.max("n_docs").alias("most"))
    weights = counts.withColumn("a_id", a_id).join(most, "a_id").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")
    )
    weights = store.keep(weights, "weights")
    linked = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "times")
    sums = (
        # Sorted on both sides at any size: the table of pairs has no proven bound.
        linked.join(weights.hint("merge"), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
