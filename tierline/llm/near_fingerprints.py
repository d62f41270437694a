"""Document fingerprints by SimHash, searched through permuted block tables (operator 11).

Only DataFrame functions run here. The terms of a text are its words with the word that
follows, so order counts; a term weighs as many code points as it has, every time it
occurs, for long words say more than short ones. Each term's hash votes with its weight
on 64 signed bits. The votes for set bits are summed two to a number, in halves of 32
bits, which holds for any text below 2 GB. A bit is set if more than half the weight
votes for it.

Search: a fingerprint is cut into ``BLOCKS`` blocks. Two that differ in at most
``RADIUS`` bits agree in at least ``BLOCKS - RADIUS`` whole blocks, so there is one table
for each choice of that many blocks, with these blocks moved to the front as its key.
Fingerprints that share a key are compared, each pair only in the first table where they
meet. Distinct fingerprints are compared, not documents; a key's fingerprints are dealt
into chunks by hash, so that no group is held whole, and only counts leave a chunk.

Defined results: a null text is empty; a text without words has fingerprint 0; texts are
taken as they are, with letters in either case. Documents are ordered by id, nulls first,
then by a hash of the text; a row that is repeated is followed by its own copy. The last
document's next one is the first, a single document's next one is itself. Other columns
are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 64
BLOCKS, RADIUS = 6, 3
CHUNK = 512
SPACES = r"[\x20\x09-\x0D]+"
KEY = ["no_id", "id", "hash"]
LEAST_LONG = -(1 << 63)


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> BITS - 1 else bits


def identified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``no_id, id, hash, text``: what identifies a document, and its text."""
    doc_id = F.col(f"`{id_column}`").cast("long")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return docs.select(doc_id.alias("id"), text.alias("text")).select(
        F.col("id").isNull().alias("no_id"),
        F.coalesce("id", F.lit(LEAST_LONG)).alias("id"),
        F.xxhash64("text", F.octet_length("text")).alias("hash"),
        "text",
    )


def successions(named: DataFrame, store) -> DataFrame:
    """Each distinct document and the one after it, in order of the key.

    ``no_id, id, hash, is_copy, rows``, the next document's key as ``next_*``, and
    ``take``, the code points an edit takes from it. ``is_copy`` marks the copies of a
    row that another copy follows. Only keys are sorted, by range; the border of each
    range is passed on as one row.
    """
    ahead = F.floor(F.length("text") / 4).alias("take")
    distinct = named.select(*KEY, ahead).groupBy(*KEY, "take").agg(F.count(F.lit(1)).alias("rows"))
    order = [F.desc("no_id"), F.asc("id"), F.asc("hash")]
    ranged = distinct.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = store.keep(ranged, "ranges")

    key = F.struct(*[F.col(c) for c in KEY])
    # Nulls come first: false sorts before true, so the flag is turned round.
    sortable = F.struct((~F.col("no_id")).alias("has_id"), F.col("id"), F.col("hash"))
    borders = ranged.groupBy("part").agg(F.min(sortable).alias("first"))
    borders = borders.select("part", F.struct((~F.col("first.has_id")).alias("no_id"), "first.id", "first.hash").alias("first"))
    # One row per range, at most as many as there are shuffle partitions.
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = borders.select(
        "part",
        F.coalesce(F.lead("first").over(Window.orderBy("part")), F.first("first").over(along)).alias("border"),
    )
    inside = F.lead(key).over(Window.partitionBy("part").orderBy(*order))
    followed = ranged.withColumn("after", inside).join(borders, "part")
    following = F.coalesce("after", "border")
    last = F.struct(F.lit(False).alias("is_copy"), F.lit(1).cast("long").alias("rows"), following.alias("next"))
    others = F.struct(F.lit(True).alias("is_copy"), (F.col("rows") - 1).alias("rows"), key.alias("next"))
    either = F.filter(F.array(last, others), lambda x: x["rows"] > 0)
    spread = followed.select(*KEY, "take", F.inline(either))
    return spread.select(*KEY, "take", "is_copy", "rows", *[F.col(f"next.{c}").alias(f"next_{c}") for c in KEY])


def edited_texts(named: DataFrame, following: DataFrame) -> DataFrame:
    """Keys, ``is_copy``, ``rows``, ``next_*``, ``text`` and ``edited``, one row per succession.

    Texts are shuffled once, by their key; only the code points an edit takes travel
    from one document to the one before it, together with what is known of that one.
    """
    texts = named.dropDuplicates(KEY)
    wanted = following.select(
        *[F.col(c).alias(f"to_{c}") for c in KEY],
        "is_copy",
        "rows",
        "take",
        *[F.col(f"next_{c}").alias(c) for c in KEY],
    )
    size = F.col("take").cast("int")
    taken = texts.join(wanted, KEY).select(
        *[F.col(f"to_{c}").alias(c) for c in KEY],
        "is_copy",
        "rows",
        "take",
        *[F.col(c).alias(f"next_{c}") for c in KEY],
        F.when(size > 0, F.substring("text", F.lit(1), size)).otherwise("").alias("taken"),
    )
    kept = F.substring("text", F.lit(1), F.length("text") - size)
    return texts.join(taken, KEY).withColumn("edited", F.concat(kept, "taken")).drop("take", "taken")


def _terms(text: Column) -> Column:
    """Words with the word that follows, as structs of two."""
    words = F.array_remove(F.split(text, SPACES), "")
    return F.arrays_zip(words.alias("word"), F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))).alias("next"))


def fingerprints(texts: DataFrame, by: list[str], text_column: str = "text") -> DataFrame:
    """``by`` and ``fp``, the signed 64-bit fingerprint of the text of each row.

    Rows with equal ``by`` must have equal texts: their votes add up, which moves no bit.
    """
    terms = texts.select(*by, F.inline_outer(_terms(F.col(text_column)))).toDF(*by, "_word", "_after")
    weight = F.coalesce(F.length("_word"), F.lit(0)) + F.coalesce(F.length("_after"), F.lit(0))
    voted = terms.select(*by, F.xxhash64("_word", "_after").alias("_h"), weight.cast("long").alias("_w"))
    half = BITS // 2
    pair = F.lit(1 | 1 << half).cast("long")
    votes = [
        F.sum(F.shiftrightunsigned("_h", bit).bitwiseAND(pair) * F.col("_w")).alias(f"_v{bit}")
        for bit in range(half)
    ]
    summed = voted.groupBy(*by).agg(F.sum("_w").alias("_all"), *votes)
    low = F.lit((1 << half) - 1).cast("long")

    def bit(at: int) -> Column:
        votes = F.col(f"_v{at % half}")
        ones = votes.bitwiseAND(low) if at < half else F.shiftrightunsigned(votes, half)
        return F.when(2 * ones > F.col("_all"), F.lit(_signed(1 << at)).cast("long")).otherwise(F.lit(0).cast("long"))

    return summed.select(*by, reduce(Column.bitwiseOR, [bit(at) for at in range(BITS)]).alias("fp"))


def tables(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """The bits in front of each table, as a mask: every choice of ``blocks - radius`` blocks."""
    cuts = [BITS * at // blocks for at in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def count_near(
    found: DataFrame, store, *, radius: int = RADIUS, blocks: int = BLOCKS, chunk: int = CHUNK
) -> DataFrame:
    """``fp, n_near``: for each distinct ``fp``, the other rows within ``radius`` bits of it.

    ``found`` has one row per document with its signed fingerprint ``fp``.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("there must be more blocks than differing bits")
    masks = [_signed(m) for m in tables(blocks, radius)]
    distinct = store.keep(found.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "distinct")
    fronts = F.array(*[F.lit(m).cast("long") for m in masks])
    keyed = distinct.select("fp", "n", F.posexplode(fronts).alias("table", "front"))
    keyed = keyed.select("fp", "n", "table", F.xxhash64("table", F.col("fp").bitwiseAND(F.col("front"))).alias("key"))
    shared = store.keep(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shared"
    )
    meeting = keyed.join(shared, "key")
    chunks = F.ceil(F.col("members") / chunk)
    dealt = meeting.withColumn("chunk", F.pmod(F.xxhash64("fp"), chunks))
    held = dealt.groupBy("key", "chunk").agg(F.collect_list(F.struct("fp", "n")).alias("others"))
    asked = meeting.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))

    def counts(other: Column) -> Column:
        differ = F.col("fp").bitwiseXOR(other["fp"])
        met = F.exists(F.slice(fronts, F.lit(1), F.col("table")), lambda m: differ.bitwiseAND(m) == 0)
        same_key = differ.bitwiseAND(F.element_at(fronts, F.col("table") + 1)) == 0
        return (differ != 0) & (F.bit_count(differ) <= radius) & same_key & ~met

    near = F.aggregate(F.filter("others", counts), F.lit(0).cast("long"), lambda total, x: total + x["n"])
    per_chunk = asked.join(held, ["key", "chunk"]).select("fp", near.alias("n_near")).where("n_near > 0")
    per_fp = per_chunk.groupBy("fp").agg(F.sum("n_near").alias("n_near"))
    return distinct.join(per_fp, "fp", "left").select(
        "fp", (F.coalesce("n_near", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_near")
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def compare_edits(docs: DataFrame, store, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text and that of the next document.

    One row per document: ``doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp, n_near``.
    The edited text has its last quarter replaced by the next document's first code points.
    """
    named = identified(docs, id_column, text_column)
    following = store.keep(successions(named, store), "successions")
    texts = edited_texts(named, following)
    by = [*KEY, "is_copy", "rows", *[f"next_{c}" for c in KEY]]
    facts = [F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256")]
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
    versions = texts.select(*by, *facts, F.inline(both))
    each = store.keep(fingerprints(versions, [*by, "n_chars", "edited_sha256", "kind"]), "fingerprints")
    own = each.where("kind = 0 and not is_copy").select(*KEY, "fp")
    edited = each.where("kind = 1").withColumnRenamed("fp", "edited_fp")
    nexts = own.select(*[F.col(c).alias(f"next_{c}") for c in KEY], F.col("fp").alias("next_fp"))
    rows = edited.join(own, KEY).join(nexts, [f"next_{c}" for c in KEY])
    one_each = rows.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    one_each = store.keep(
        one_each.select(
            F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"
        ),
        "documents",
    )
    return one_each.join(count_near(one_each.select("fp"), store), "fp")


def digest(compared: DataFrame) -> DataFrame:
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_digits("fp").alias("fingerprint"),
        hex_digits("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_near",
    )
