"""Text under a collation as bytes that compare the same way.

Spark compares two texts under an ICU collation through a collator that all threads of an
executor share and lock, once per comparison of a sort. Here each value is turned into its
sort key once, and joins, sorts and groups see plain bytes. Texts of letters, digits, spaces,
hyphens and underscores alone, as most keys are, get theirs by replacing characters, without
the collator.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BINARY = "UTF8_BINARY"
_ALNUM = string.digits + string.ascii_letters
_ALPHABETS = (_ALNUM + " _-", _ALNUM + "_-", _ALNUM)
_IMAGES: dict[str, tuple[dict[str, str], bytes] | None] = {}


def _images(spark: SparkSession, collation: str) -> tuple[dict[str, str], bytes] | None:
    """Characters, what each contributes to a sort key in any company, and a key's end.

    ``None`` where the collation has no such alphabet, as it also compares accents or case,
    or takes some of its letters together. All pairs are tried, the last ones at the end of
    the text; a longer group of letters that counts as one begins with a pair that does.
    """
    if collation not in _IMAGES:
        jvm = spark._jvm
        factory = jvm.org.apache.spark.sql.catalyst.util.CollationFactory
        number = factory.collationNameToId(collation)

        def key(text: str) -> bytes:
            utf8 = jvm.org.apache.spark.unsafe.types.UTF8String.fromString(text)
            return bytes(factory.getCollationKeyBytes(utf8, number))

        def found(letters: str) -> tuple[dict[str, str], bytes] | None:
            end = key("")
            of = {c: key(c).removesuffix(end) for c in letters}
            longer = {b for image in of.values() if len(image) > 1 for b in image}
            texts = ["".join(a + b for a in letters for b in letters), *(a + letters[-1] for a in letters)]
            texts += [letters[0] + b for b in letters]
            if (
                any(not image or max(image) > 127 or 0 in image for image in of.values())
                or any(len(of[c]) > 1 for c in _ALNUM)
                or longer & set(letters.encode())
                or any(key(t) != b"".join(of[c] for c in t) + end for t in texts)
            ):
                return None
            return {c: image.decode("ascii") for c, image in of.items()}, end

        _IMAGES[collation] = next(filter(None, map(found, _ALPHABETS)), None)
    return _IMAGES[collation]


def sort_key(spark: SparkSession, name: str, collation: str) -> Column:
    """The bytes by which a text column compares under ``collation``; NULL for NULL."""
    jvm = spark._jvm
    convert = jvm.org.apache.spark.sql.classic.ExpressionUtils
    text = convert.expression(F.collate(name, collation)._jc)
    by_collator = Column(convert.column(jvm.org.apache.spark.sql.catalyst.expressions.CollationKey(text)))
    images = _images(spark, collation)
    if images is None:
        return by_collator
    of, end = images
    plain = replaced = F.collate(name, BINARY)
    # The bytes of longer images are not letters themselves, so that they are left alone then.
    for letter, image in of.items():
        if len(image) > 1:
            replaced = F.replace(replaced, F.lit(letter), F.lit(image))
    single = {c: image for c, image in of.items() if len(image) == 1}
    replaced = F.translate(replaced, "".join(single), "".join(single.values())).cast("binary")
    whole = F.concat(replaced, F.lit(end)) if end else replaced
    return F.when(plain.rlike(rf"\A[{re.escape(''.join(of))}]*\z"), whole).otherwise(by_collator)
