"""Threshold-scaled document sketches, in DataFrame functions only.

A sketch keeps every word-shingle hash below a fixed fraction of the hash range (``1 / scale``), so a long text keeps
proportionally more than a short one, sketches of parts merge by union, and the share of one sketch that another holds estimates containment
between texts of very unequal size. Shingles are ``shingle`` consecutive words (runs of non-space characters, lower-cased in A-Z), hashed by
XXH64 word by word and combined; a text with fewer words is one shingle; a text without words has an empty sketch.

A fingerprint string is the kept hashes in ascending order, 16 hex digits each. Equal texts have equal fingerprints. Two empty sketches
are alike (1.0) when the texts' words are equal, else unlike (0.0); an empty and a filled one have likeness 0.

Defined cases: null text is empty; repeated rows are sketched each; null keys are ordinary rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martlet.llm.common import free_names, words

SHINGLE = 5
SCALE = 8


def _lower(text: Column) -> Column:
    """A-Z lower-cased; ``lower`` does just that to texts of ASCII only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """Sorted distinct shingle hashes below the threshold (array of bigint)."""
    # the hash range as signed longs starts at its minimum
    most = F.lit(-(1 << 63) + (1 << 64) // scale)

    def kept(hashes: Column) -> Column:
        starts = F.when(F.size(hashes) == 0, F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(0), F.greatest(F.size(hashes) - shingle, F.lit(0))))
        return F.filter(F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(shingle)])), lambda h: h < most)

    # the one-element array binds the word hashes to a variable, so they are computed once and not once per shingle
    hashes = F.transform(words(_lower(text)), lambda w: F.xxhash64(w))
    return F.array_sort(F.array_distinct(F.get(F.transform(F.array(hashes), kept), 0)))


def as_string(kept: Column) -> Column:
    return F.array_join(F.transform(kept, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Jaccard likeness of two sketches; ``same`` decides between two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.when(same, 1.0).otherwise(0.0)).otherwise(shared / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; null for an empty sketch."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def merged(sketches: DataFrame, by: str, kept: str = "kept") -> DataFrame:
    """One sketch per group: the union of its rows' sketches, hash by hash, so a large group is combined map-side."""
    hashes = sketches.select(by, F.explode(kept).alias("h")).distinct()
    return hashes.groupBy(by).agg(F.array_sort(F.collect_list("h")).alias(kept))


def with_next(docs: DataFrame, key: str, order: str, columns: list[str], rows_per_range: int = 500) -> tuple[DataFrame, str]:
    """``docs`` with a struct of ``columns`` of the next row in descending order of (key, order), nulls last, and that column's name.

    The last row's next one is the first. Rows are cut into ranges by approximate quantiles of the key; a key that fills several ranges
    (null too) is cut further by ``order``, a hash. Each range has a window of its own. What follows a range's last row is the first row of the next
    range: these first rows, one per range and at most 4,096 ranges or so, are copied into the range before. Rows equal in both are interchangeable.
    """
    r, sub, copied, following = free_names(docs.columns, "range", "part", "copied", "next")
    total, nulls = docs.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    n = min(max((total or 0) // rows_per_range, 1), 4096)
    cuts = (docs.select(F.percentile_approx(key, [k / n for k in range(1, n)], 10_000)).first()[0] or []) if n > 1 else []
    parts = {c: cuts.count(c) + 1 for c in set(cuts) if cuts.count(c) > 1}
    cuts = sorted(set(cuts))
    value = F.col(key)
    # ranges count from the largest keys; the rank of a key is the number of cuts above it
    rank = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > value)) if cuts else F.lit(0)
    of_key = F.lit(1)
    if parts:
        known = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
        of_key = F.coalesce(F.element_at(known, value), of_key)
    pieces = F.when(value.isNull(), F.lit(-(-nulls // rows_per_range))).otherwise(of_key)
    # parts of a key, too, count from the largest hashes: 53 high bits as a share of the hash range
    share = (F.shiftright(F.col(order), 11) + F.lit(1 << 52)) / F.lit(1 << 53)
    ranged = (docs.withColumn(r, F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(rank))
              .withColumn(sub, F.when(pieces > 1, pieces - 1 - F.floor(share * pieces)).otherwise(0).cast("int"))
              .withColumn(copied, F.lit(False)))
    place = F.struct(F.col(key).isNotNull().alias("has_key"), value.alias("key"), F.col(order).alias("order"))
    heads = sorted(((x[0], x[1], x[2]) for x in ranged.groupBy(r, sub).agg(F.max(place)).collect()), key=lambda x: x[:2])
    if not heads:
        return ranged.withColumn(following, F.struct(*columns)).drop(r, sub, copied), following
    before = [(h[2]["key"], h[2]["order"], *heads[i - 1][:2]) for i, h in enumerate(heads)]
    kind = docs.schema[key].dataType.simpleString()
    h_key, h_order, h_r, h_sub = free_names([*docs.columns, r, sub, copied, following], "head_key", "head_order", "head_range", "head_part")
    named = docs.sparkSession.createDataFrame(before, f"{h_key} {kind}, {h_order} long, {h_r} int, {h_sub} int")
    copies = (docs.join(F.broadcast(named), value.eqNullSafe(F.col(h_key)) & (F.col(order) == F.col(h_order)))
              .select(*docs.columns, F.col(h_r).alias(r), F.col(h_sub).alias(sub), F.lit(True).alias(copied)))
    inside = Window.partitionBy(r, sub).orderBy(F.col(copied), value.desc_nulls_last(), F.col(order).desc())
    # one lead per plain column: a struct inside the window would travel through the shuffle beside its columns
    both = ranged.unionByName(copies).withColumn(following, F.struct(*[F.lead(c).over(inside).alias(c) for c in columns]))
    return both.filter(~F.col(copied)).drop(r, sub, copied), following


def compare_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Each text's sketch beside that of the text with its second half replaced by the start of the next document, and the next document's.

    Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, held_by_next (containment).
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("key", "text", F.xxhash64("text").alias("content"), sketch(F.col("text"), shingle, scale).alias("kept"))
    paired, following = with_next(rows, "key", "content", ["text", "kept"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col(following)["text"], F.lit(1), half))
    done = (paired.select("key", "text", "kept", F.col(following)["text"].alias("next_text"), F.col(following)["kept"].alias("next_kept"),
                          n.cast("bigint").alias("n_chars"), edited.alias("edited"))
            .withColumn("edited_kept", sketch(F.col("edited"), shingle, scale)))
    same = lambda a, b: words(_lower(F.col(a))) == words(_lower(F.col(b)))
    return done.select(
        F.col("key").alias(key), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("kept")).alias("fingerprint"), as_string(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("kept"), F.col("edited_kept"), same("text", "edited")).alias("near_edited"),
        likeness(F.col("kept"), F.col("next_kept"), same("text", "next_text")).alias("near_next"),
        containment(F.col("kept"), F.col("next_kept")).alias("held_by_next"))
