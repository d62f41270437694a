"""Operators 11 to 13 against brute force, with nulls, ties, repeated and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings as limits
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierline.llm import alignment, near_fingerprints, spelling
from tierline.llm.common import Store

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Names that the operators use themselves, as extra columns.
SCHEMA = "doc_id long, text string, fp long, hash string, row int, word string, n long, key long, pairs string"


@pytest.fixture()
def store(spark):
    return Store(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None, None, None, None) for r in rows], SCHEMA)


def prose(seed, n, letters="abcdeéß"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(n))


TEXTS = [None, "", "  \n", "one", "Ünï €😀 code points", prose(1, 300), prose(1, 300), prose(2, 40), prose(3, 9000)]
TEXTS += [prose(1, 300) + " more", "a <|endoftext|> b </s> <0x41> ▁x", "x" * 5000, "tab\tand\r\nline  two   spaces "]
ROWS = [*enumerate(TEXTS), (None, "loose words here"), (None, None), (5, TEXTS[5]), (5, "same id, other text"), (5, TEXTS[5])]


# -- 11 ------------------------------------------------------------------------


def test_edited_texts_follow_the_order_of_ids(spark, store):
    got = near_fingerprints.digest(near_fingerprints.compare_edits(frame(spark, ROWS), store)).collect()
    assert len(got) == len(ROWS)
    order = spark.createDataFrame([(i, t or "") for i, t in ROWS], "i long, t string").selectExpr(
        "i", "t", "xxhash64(t, octet_length(t)) h"
    )
    ordered = sorted(order.collect(), key=lambda r: (r.i is not None, r.i or 0, r.h))
    wanted = []
    for at, r in enumerate(ordered):
        after = ordered[(at + 1) % len(ordered)].t
        take = len(r.t) // 4
        edited = r.t[: len(r.t) - take] + after[:take]
        wanted.append((r.i, len(r.t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(wanted, key=str)
    by_text = defaultdict(set)
    for r in got:
        by_text[(r.n_chars, r.fingerprint)].add(r.doc_id)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert {5, 6} <= by_text[(len(TEXTS[5]), next(r.fingerprint for r in got if r.doc_id == 6))]
    assert {r.fingerprint for r in got if r.doc_id in (0, 1, 2)} == {"0" * 16}


def test_votes_match_plain_counting(spark, store):
    texts = [t or "" for t in TEXTS]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: r.fp for r in near_fingerprints.fingerprints(df, ["i"]).collect()}
    for i, text in enumerate(texts):
        found = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        terms = [(w, found[at + 1] if at + 1 < len(found) else None) for at, w in enumerate(found)]
        votes = [0] * 64
        if terms:
            hashed = spark.createDataFrame(terms, "a string, b string").selectExpr("xxhash64(a, b) h", "a", "b").collect()
            for r in hashed:
                weight = len(r.a) + len(r.b or "")
                for bit in range(64):
                    votes[bit] += weight if r.h >> bit & 1 else -weight
        bits = sum(1 << bit for bit in range(64) if votes[bit] > 0)
        assert got[i] & (1 << 64) - 1 == bits, i


def test_edited_text_is_nearer_than_the_next(spark, store):
    rows = [(i, prose(100 + i, 200)) for i in range(40)]
    got = near_fingerprints.digest(near_fingerprints.compare_edits(frame(spark, rows), store)).collect()
    assert min(r.near_edited for r in got) > max(r.near_next for r in got) - 0.05
    assert sum(r.near_edited for r in got) / 40 > 0.72 and sum(r.near_next for r in got) / 40 < 0.65


@pytest.mark.parametrize("radius, blocks, chunk", [(3, 6, 512), (3, 5, 4), (0, 4, 8), (5, 8, 3)])
def test_tables_find_all_within_the_radius(spark, store, radius, blocks, chunk):
    r = random.Random(radius)
    values = [r.getrandbits(64) for _ in range(30)]
    for v in values[:12]:
        values += [v ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 6))) for _ in range(12)]
    values += [0] * 9 + [values[0]] * 4
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {x.fp: x.n_near for x in near_fingerprints.count_near(df, store, radius=radius, blocks=blocks, chunk=chunk).collect()}
    for v, s in zip(values, signed):
        assert got[s] == sum((v ^ w).bit_count() <= radius for w in values) - 1


def test_fingerprints_of_one_row_and_none(spark, store, empty):
    (r,) = near_fingerprints.digest(near_fingerprints.compare_edits(frame(spark, [(1, "abcdefgh")]), store)).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1 and r.n_near == 0
    assert near_fingerprints.digest(near_fingerprints.compare_edits(empty, store)).collect() == []


def test_no_python_on_the_fingerprint_path(spark, store):
    named = near_fingerprints.identified(frame(spark, ROWS))
    plan = near_fingerprints.fingerprints(named, near_fingerprints.KEY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


# -- 12 ------------------------------------------------------------------------


def lowered(run):
    return re.sub("[A-Z]", lambda m: m[0].lower(), run)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in map(lowered, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in known if one_edit(w, v)] for w in known}
    form = {}
    for w, n in known.items():
        best = min(near[w], key=lambda v: (-known[v], v), default=None)
        if best is not None and known[best] >= 10 * n:
            form[w] = best
    out = []
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), known.get(form.get(w))))
    return sorted(out)


def spelled(seed):
    r = random.Random(seed)
    base = ["encyclop", "naïveté", "müßigeÀ", "parallel", "paralel", "parallell", "aaaaaaaa", "aaaaaaa", "bababab"]
    rows = []
    for i in range(60):
        found = []
        for _ in range(60):
            w = base[min(int(r.expovariate(0.6)), len(base) - 1)]
            if r.random() < 0.05:
                at = r.randrange(len(w))
                w = w[:at] + r.choice(["", "x", "é", w[at] * 2]) + w[at + 1 :]
            found.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i, r.choice([" ", "-", "×", "1"]).join(found)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_all_pairs(spark, store, seed):
    rows = [*spelled(seed), (None, "parallel parallex"), (None, None), (3, ""), (7, "parallel " * 300), (8, "z" * 9000), (9, "z" * 9000)]
    got = sorted(tuple(r) for r in spelling.group_variants(frame(spark, rows), store).collect())
    wanted = variants(rows)
    assert got == wanted
    assert any(w[1] for w in wanted) and any(w[4] > 3 for w in wanted)


def test_chains_reach_the_last_form(spark, store):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000}
    rows = [(0, " ".join(" ".join([w] * n) for w, n in counts.items()))]
    wanted = variants(rows)
    got = sorted(tuple(r) for r in spelling.group_variants(frame(spark, rows), store).collect())
    assert got == wanted and {w[2] for w in wanted} == {"aaabbbb"}


@limits(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=9), st.lists(st.integers(1, 5), min_size=1, max_size=9))
def test_reduced_neighbours_meet_on_one_side(a, b):
    def keys(word):
        parts = list(spelling.neighbour_keys(np.array(word)))
        return int(parts[0][0]), {int(k) for p in parts for k in p}

    (ka, na), (kb, nb) = keys(a), keys(b)
    near = a == b or one_edit("".join(map(str, a)), "".join(map(str, b)))
    assert near == (kb in na or ka in nb)
    assert a == b or not (kb in na and ka in nb)


def test_variants_of_nothing(spark, store, empty):
    assert spelling.group_variants(empty, store).collect() == []
    assert spelling.group_variants(frame(spark, [(1, None), (2, "short words")]), store).collect() == []


# -- 13 ------------------------------------------------------------------------


def plain_alignment(rows):
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in own} | {chr(256 + at): b for at, b in enumerate(b for b in range(256) if b not in own)}
    docs = []
    for doc_id, text in rows:
        a, b = [], []
        if text:
            spaced = " " + text
            e = t.encode(spaced, add_special_tokens=False)
            a = [(i, bytes(byte_of[c] for c in token)) for i, token in zip(e.ids, e.tokens)]
            for i in sp.encode(text):
                p = sp.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) != spaced.encode() or b"".join(x for _, x in b) != spaced.encode():
                a, b = [], []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        sa, sb = spans
        links = [(x[0], y[0]) for x in sa for y in sb if x[1] < y[2] and y[1] < x[2]] if len(sa) < 4000 else None
        cuts = sorted({x[2] for x in sa} & {y[2] for y in sb})
        parts, last = [], 0
        for cut in cuts if links is not None else []:
            own = [",".join(str(x[0]) for x in side if last < x[2] <= cut) for side in (sa, sb)]
            parts.append("|".join(own))
            last = cut
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        docs.append((doc_id, len(a), len(b), len(cuts), links, digest))
    counts = Counter(p for d in docs for p in set(d[4]))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [
        (i, na, nb, g, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), digest)
        for i, na, nb, g, links, digest in docs
    ]


def test_alignment_matches_all_overlaps(spark, store):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect()
    rows = [(i, t if t is None or len(t) < 6000 else t[:6000]) for i, t in ROWS] + [(r.doc_id, r.text[:2500]) for r in texts]
    got = alignment.align_tokenizers(frame(spark, rows), store, BYTES, PIECES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_alignment(rows), key=str)
    assert sum(r.n_a > 0 for r in got) > 20 and any(r.n_groups < min(r.n_a, r.n_b) for r in got)


@limits(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.randoms(use_true_random=False), st.integers(1, 12))
def test_runs_cut_at_common_ends(sizes, rnd, window):
    total = sum(sizes)
    a = np.cumsum(sizes)
    b = np.array(sorted({total, *rnd.sample(range(1, total + 1), rnd.randint(0, total))}))
    found = np.concatenate(list(alignment.groups(a, b, window))).tolist()
    ends, at = [], [0, 0]
    for i, j, n, p, q in found:
        assert [i, j] == at
        assert (a[i : i + n] == b[j : j + n]).all()
        ends += a[i : i + n].tolist()
        if p > i + n:
            assert a[p - 1] == b[q - 1] and (p - i - n, q - j - n) != (1, 1)
            ends.append(int(a[p - 1]))
        else:
            assert q == j + n
        at = [p, q]
    assert ends == sorted(set(a.tolist()) & set(b.tolist())) and at == [len(a), len(b)]


def test_byte_ids_equal_the_library_call():
    tokenizers = alignment.Tokenizers(BYTES, PIECES)
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    r = random.Random(11)
    signs = [*" \n\t  \x1c\x85\xa0ab'sé\u0301Σ1٣.,!<>|中　K\u200b ", "'s", "  ", "<|endoftext|>", "\n \n", "ab,", "x" * 600, "😀"]
    for _ in range(600):
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 30)))
        a = np.array(tokenizers.encoding.encode_ordinary(text))
        assert a.tolist() == t.encode(text, add_special_tokens=False).ids
        assert tokenizers.a.text(a) == text.encode()


def test_windows_do_not_change_the_result():
    tokenizers = alignment.Tokenizers(BYTES, PIECES)
    a, b = tokenizers.encode(prose(5, 3000))
    whole = alignment.align(a, b, tokenizers)
    before = alignment.groups.__defaults__
    alignment.groups.__defaults__ = (64,)
    try:
        parts = alignment.align(a, b, tokenizers)
    finally:
        alignment.groups.__defaults__ = before
    assert whole[:3] == parts[:3]
    assert (whole[3] == parts[3]).all() and (whole[4] == parts[4]).all()


def test_alignment_of_nothing(spark, store, empty):
    assert alignment.align_tokenizers(empty, store, BYTES, PIECES).collect() == []


def test_reduced_symbols_are_balanced(spark):
    df = spark.createDataFrame([("abcabcab",), ("ddddeeee",)], "word string")
    codes = spelling.letter_symbols(df, 4)
    assert set(codes.values()) == {0, 1, 2, 3} and spelling.symbols_for(1) == 4 and spelling.symbols_for(10**9) > 8
