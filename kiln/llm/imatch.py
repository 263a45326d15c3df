"""I-Match document fingerprints, in DataFrame functions only.

Terms are the lower-cased runs of letters and digits, identified by their 64-bit
hash.  Only terms whose inverse document frequency lies in a band count
(``RARE <= documents with the term / documents <= COMMON``, at least two
documents): very common terms say nothing, very rare ones are noise.  A text's
distinct terms in the band are sorted and hashed once for the whole lexicon and
once for each of several seeded random subsets of it, from two thirds of the
lexicon down to a thousandth: a large subset changes with any edit, a small one
survives most, so that the share of equal ones follows the share of equal terms.  The fingerprint is the sequence of these hashes; the likeness of
two fingerprints is the share of equal hashes among the subsets that are not
empty for both.

Size of the lexicon: every term in it is in at least ``RARE`` of the documents,
so it has at most (mean distinct terms of a document) / ``RARE`` terms, however
many documents there are.  It is counted, and sent to all tasks only below
``LEXICON_ROWS``; beyond that it is joined by shuffles.

Defined cases: null text is empty; a text without terms in the band hashes all
its distinct terms in place of the whole lexicon; without any term all hashes are
zero; two empty fingerprints are alike (1.0); repeated rows and ids are kept, in
the order of their text's hash; rows without an id come last; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import materialize

RARE, COMMON = 0.001, 0.1
# Share of the lexicon in each random subset after the whole one.
KEEP = (2 / 3, 2 / 3, 1 / 3) + (1 / 64,) * 8 + (1 / 256,) * 8 + (1 / 1024,) * 8
SMALL = 1 / 16        # subsets up to this share are looked up among their own terms only
LEXICON_ROWS = 4_000_000
SEGMENTS = 256
ROWS_PER_PART = 1_000
NOT_A_TERM = r"[^\p{L}\p{N}]+"
EMPTY = 42            # xxhash64 of an empty array is its seed
MARK = 0              # stands for "no term": in every text once, in no subset


def term_hashes(text):
    """The distinct terms of a text column as an array of 64-bit hashes."""
    words = F.array_remove(F.split(F.lower(text), NOT_A_TERM), "")
    return F.array_distinct(F.transform(words, lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, keep=KEEP, rare: float = RARE, common: float = COMMON) -> DataFrame:
    """(h, code) of the terms in the band: ``code`` is the hash with its lowest
    bits replaced by the term's subsets (bit 0: the whole lexicon)."""
    spark = docs.sparkSession
    n = docs.count()
    seen = docs.select(F.explode(term_hashes(F.coalesce(F.col("text"), F.lit("")))).alias("h"))
    band = (seen.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
            .where((F.col("df") >= max(2, math.ceil(rare * n))) & (F.col("df") <= max(2, math.floor(common * n))))
            .where(F.col("h") != MARK))
    bits = len(keep) + 1
    draw = [F.when(F.pmod(F.xxhash64(F.col("h"), F.lit(j)), F.lit(1 << 20)) < int(share * (1 << 20)), F.lit(1 << j)).otherwise(F.lit(0))
            for j, share in enumerate(keep, 1)]
    mask = F.lit(1)
    for d in draw:
        mask = mask.bitwiseOR(d)
    own = F.shiftleft(F.shiftright("h", bits), bits).bitwiseOR(mask.cast("long"))
    mark = spark.range(1).select(F.lit(MARK).cast("long").alias("h"), F.lit(0).cast("long").alias("code"))
    return materialize(band.select("h", own.alias("code")).union(mark), "lexicon")


def _with_codes(df: DataFrame, keys: list[str], arrays: list[str], info: list[str], words: DataFrame, keep) -> DataFrame:
    """One row per ``keys`` again: ``info`` as it was, and for each column of
    ``arrays`` (term hashes) the sorted codes of those in the lexicon.  ``df`` is
    partitioned on the first key, so nothing but the lexicon moves."""
    each = F.inline(F.array(*[F.struct(F.lit(i).alias("_kind"), F.array_append(F.col(a), F.lit(MARK).cast("long")).alias("_terms"))
                              for i, a in enumerate(arrays)]))
    flat = (df.select(*keys, *info, each)
            .select(*keys, *info, "_kind", F.explode("_terms").alias("h"))
            .join(words, "h")
            .select(*keys, "_kind", "code",
                    F.when((F.col("h") == MARK) & (F.col("_kind") == 0), F.struct(*info)).alias("_info")))
    found = flat.groupBy(*keys).agg(
        F.first("_info", ignorenulls=True).alias("_info"),
        *[F.collect_list(F.when((F.col("_kind") == i) & (F.col("code") != 0), F.col("code"))).alias(a) for i, a in enumerate(arrays)])
    found = found.select(*keys, *[F.col("_info")[c].alias(c) for c in info], *[F.sort_array(a).alias(a) for a in arrays])
    small = sum(1 << j for j, share in enumerate(keep, 1) if share <= SMALL)
    return found.select("*", *[F.filter(a, lambda c: c.bitwiseAND(F.lit(small)) != 0).alias(f"{a}_few") for a in arrays])


def _hashes(codes: str, every, keep):
    """The fingerprint of a sorted array of codes as an array of longs."""
    def subset(j, share):
        h = F.xxhash64(F.filter(f"{codes}_few" if share <= SMALL else codes, lambda c: c.bitwiseAND(F.lit(1 << j)) != 0))
        return F.when(h == EMPTY, F.lit(0).cast("long")).otherwise(h)

    whole = F.when(F.size(codes) > 0, F.xxhash64(codes)).when(every == EMPTY, F.lit(0).cast("long")).otherwise(every)
    return F.array(whole, *[subset(j, share) for j, share in enumerate(keep, 1)])


def likeness(a, b):
    """Share of equal hashes among the subsets that are not empty for both."""
    pairs = F.arrays_zip(a.alias("x"), b.alias("y"))
    filled = F.size(F.filter(pairs, lambda p: (p["x"] != 0) | (p["y"] != 0)))
    equal = F.size(F.filter(pairs, lambda p: (p["x"] == p["y"]) & (p["x"] != 0)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled).cast("double")


def text_of(hashes):
    """Fingerprint as text: 8 hex digits per hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.right(F.lpad(F.hex(h), 16, "0"), F.lit(8)))), "")


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _tie, _part): key ranges of about ROWS_PER_PART rows, equal
    in depth at SEGMENTS quantiles of the ids and in width inside them."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("_tie", F.xxhash64("text"))
    row = base.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"),
                   F.percentile_approx("doc_id", [i / SEGMENTS for i in range(1, SEGMENTS)], 10_000).alias("cuts")).first()
    cuts = sorted({row["low"], *(row["cuts"] or [])}) if row["low"] is not None else [0]
    fine = max(1, math.ceil(row["n"] / ROWS_PER_PART / len(cuts)))
    bounds = F.lit(cuts)
    segment = F.greatest(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))), F.lit(1))
    low = F.element_at(bounds, segment)
    width = F.greatest(F.coalesce(F.try_element_at(bounds, segment + 1), low + ROWS_PER_PART) - low, F.lit(1))
    inside = F.least(F.floor((F.col("doc_id") - low) / width * fine), F.lit(fine - 1))
    part = F.when(F.col("doc_id").isNull(), -1 - F.pmod("_tie", F.lit(fine * len(cuts)))).otherwise(segment * F.lit(fine) + inside)
    return base.withColumn("_part", part.cast("long"))


def fingerprints_with_edits(docs: DataFrame, keep=KEEP) -> DataFrame:
    """For every row its fingerprint and that of its edited text: the last
    floor(n / 2) code points replaced by the first as many of the next document
    by descending id (after the last one: the first).  Columns doc_id, n_chars,
    edited_sha256, own, edited (arrays of hashes), near_edited, near_next."""
    words = lexicon(docs, keep)
    words = F.broadcast(words) if words.count() <= LEXICON_ROWS else words
    base = in_order(docs)
    order = [F.col("doc_id").desc_nulls_last(), F.col("_tie")]

    # The first document of every key range is the next of the range before it.
    first = base.groupBy("_part").agg(F.min(F.struct((-F.col("doc_id")).alias("_down"), F.col("_tie"))).alias("_at"))
    first = materialize(first.select("_part", "_at._tie", (-F.col("_at._down")).alias("doc_id")), "firsts")
    turn = Window.orderBy(F.col("_part").desc())   # one row per range
    follow = first.select(F.col("_part").alias("_before"),
                          F.coalesce(F.lead("_part").over(turn), F.first("_part").over(turn)).alias("_part"))
    heads = (base.join(first.select("_part", "_tie", F.col("doc_id").alias("_id")), ["_part", "_tie"])
             .where(F.col("doc_id").eqNullSafe(F.col("_id"))).groupBy("_part").agg(F.min("text").alias("text")))
    heads = heads.withColumn("_own", term_hashes("text"))
    heads = heads.withColumn("_all", F.xxhash64(F.sort_array("_own")))
    heads = _with_codes(heads, ["_part"], ["_own"], ["text", "_all"], words, keep)
    heads = heads.select("_part", F.col("text").alias("_head"), _hashes("_own", F.col("_all"), keep).alias("_head_own"))
    edge = materialize(heads.join(follow, "_part").select(F.col("_before").alias("_part"), "_head", "_head_own"), "heads")

    w = Window.partitionBy("_part").orderBy(*order)
    rows = base.select("_part", "doc_id", "text", F.row_number().over(w).alias("_row"), F.lead("text").over(w).alias("_lead"))
    ends = edge.select(F.col("_part").alias("_p"), "_head")
    rows = (rows.join(ends, (F.col("_part") == F.col("_p")) & F.col("_lead").isNull(), "left")
            .select("_part", "_row", "doc_id", "text", F.coalesce("_lead", "_head").alias("_next")))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("_changed", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("_next", half)))
    rows = rows.select("_part", "_row", "doc_id", "n_chars", F.sha2(F.col("_changed").cast("binary"), 256).alias("edited_sha256"),
                       term_hashes("text").alias("_own"), term_hashes("_changed").alias("_edit"))
    rows = rows.withColumns({"_all": F.xxhash64(F.sort_array("_own")), "_all_edit": F.xxhash64(F.sort_array("_edit"))})
    rows = _with_codes(rows, ["_part", "_row"], ["_own", "_edit"], ["doc_id", "n_chars", "edited_sha256", "_all", "_all_edit"], words, keep)
    rows = rows.select("_part", "_row", "doc_id", "n_chars", "edited_sha256", _hashes("_own", F.col("_all"), keep).alias("own"),
                       _hashes("_edit", F.col("_all_edit"), keep).alias("edited"))
    rows = rows.withColumn("_lead", F.lead("own").over(Window.partitionBy("_part").orderBy("_row")))
    ends = edge.select(F.col("_part").alias("_p"), "_head_own")
    rows = rows.join(ends, (F.col("_part") == F.col("_p")) & F.col("_lead").isNull(), "left")
    return rows.select("doc_id", "n_chars", "edited_sha256", "own", "edited", likeness(F.col("own"), F.col("edited")).alias("near_edited"),
                       likeness(F.col("own"), F.coalesce("_lead", "_head_own")).alias("near_next"))
