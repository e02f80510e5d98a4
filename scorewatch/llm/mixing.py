"""Mix sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

A source's target is its share by weight of all words, at most `max_epochs` times its own size; what a clamped source
cannot give is shared again by weight among the rest, until no source is above its cap. The level is found by
aggregates over the table of sources, so neither sources nor documents meet in one task.

Every document is repeated `floor(target / source_size)` times whole; the remaining fraction of a repetition takes a
seeded run of its words, rounded up or down by a seeded draw, so a source's words meet its target to within the
rounding of its documents. Draws are hashes of seed and doc_id: reruns, layout and cluster size do not matter.
`mix` plans, `mixed_documents` adds the texts of the mix to each document, and `emitted` makes them rows of their own.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null source is a source, last in order; a source
without words gets target 0; documents with null ids draw by their text; repeated rows are documents of their own; an empty
table gives no rows. Columns other than doc_id, source and text are ignored by `mix`; `mixed_documents` keeps them all, and
its own columns whose names are taken are called `mix_<name>`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, global_index, keyed_join, stored, text_of, word_count

# Weights in the order of the sources, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 7
PLAN = ("size", "source_size", "target", "taken", "whole", "part_words", "part_start")


def draw_key() -> Column:
    """What a document draws by: its id, or its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(text_of().cast("binary")))).alias("draw_key")


def draw(seed: int, purpose: str) -> Column:
    """Uniform in [0, 1) from seed, purpose and document."""
    key = F.concat(F.lit(f"{seed}:{purpose}:"), F.col("draw_key"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from rows (source, size)."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = global_index(per_source, F.col("source").asc_nulls_last())
    ranked = stored(
        ranked.select(
            "source",
            "source_size",
            F.element_at(cycle, (F.col("position") % len(weights)).cast("int") + 1).cast("double").alias("weight"),
            (F.col("source_size") * max_epochs).cast("double").alias("most"),
        ),
        "sources",
    )
    first = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level, clamped = float(first[0] or 0), float(first[0] or 0) / (first[1] or 1.0), -1
    rest, rest_weight = total, first[1] or 1.0
    while True:
        # one row of sums; every round clamps at least one more source or is the last
        over = F.col("weight") * F.lit(rest) / F.lit(rest_weight) > F.col("most")
        n, capped, free = ranked.agg(
            F.count_if(over), F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == clamped or not free:
            break
        clamped, rest, rest_weight = n, total - (capped or 0.0), free
    share = F.col("weight") * F.lit(rest) / F.lit(rest_weight)
    return ranked.select("source", "source_size", F.least(share, F.col("most")).alias("target"))


def repetitions(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Add whole, part_words, part_start and taken to rows with draw_key, size, source_size, target."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    part = F.floor((F.col("__rate") - F.floor("__rate")) * F.col("size") + draw(seed, "round")).cast("long")
    return (
        rows.withColumn("__rate", rate)
        .withColumn("whole", F.floor("__rate").cast("long"))
        .withColumn("part_words", F.least(F.col("size"), part))
        .withColumn(
            "part_start", F.floor(draw(seed, "start") * (F.col("size") - F.col("part_words") + 1)).cast("long")
        )
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("part_words"))
        .drop("__rate")
    )


def _with_targets(rows: DataFrame, sizes: DataFrame, weights, max_epochs) -> DataFrame:
    targets = source_targets(sizes, weights, max_epochs)
    return keyed_join(rows, targets, ["source"], "inner", broadcast=targets.count() <= BROADCAST_ROWS)


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, whole, part_words, part_start: one row per document."""
    sizes = stored(docs.select("doc_id", draw_key(), "source", word_count(text_of()).alias("size")), "sizes")
    rows = repetitions(_with_targets(sizes, sizes.select("source", "size"), weights, max_epochs), seed)
    return rows.select("doc_id", *PLAN)


def cut_words(text: Column, start: Column, n: Column) -> Column:
    """The run of n words from word `start` (0 is the first), with the blanks between them as they are."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # a word with the blanks before it
    run = F.array_join(F.slice(pieces, start.cast("int") + 1, n.cast("int")), "")
    return F.regexp_replace(run, r"\A[\x20\x09-\x0D]+", "")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents that the mix takes at least a word of, in all their columns, with the columns of `mix` and `emitted`.

    `emitted` holds the texts that the document gives to the mix: the whole text `whole` times, then the run of
    `part_words` words from `part_start`, if any.
    """
    sizes = stored(docs.select("source", word_count(text_of()).alias("size")), "sizes")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = docs.select(own, draw_key(), "source", word_count(text_of()).alias("size"))
    rows = repetitions(_with_targets(rows, sizes, weights, max_epochs), seed).where("taken > 0")
    text = F.col("own.text")
    copies = F.array_repeat(text, F.col("whole").cast("int"))
    part = F.array(cut_words(text, F.col("part_start"), F.col("part_words")))
    texts = F.when(F.col("part_words") > 0, F.concat(copies, part)).otherwise(copies)
    rows = rows.withColumn("emitted", texts)
    free = {name: _free(name, docs.columns) for name in (*PLAN, "emitted")}
    return rows.select("own.*", *[F.col(name).alias(out) for name, out in free.items()])


def _free(name: str, taken) -> str:
    while name in taken:
        name = f"mix_{name}"
    return name


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix: one row per whole repetition and one per cut run, its words in `text`, numbered by `repetition`.

    `mixed` are rows of `mixed_documents`, its own columns last; n_chars, where there, follows the text.
    """
    columns, texts = mixed.columns[: -len(PLAN) - 1], mixed.columns[-1]
    number = _free("repetition", columns)
    rows = mixed.select(*[c for c in columns if c != "text"], F.posexplode(texts).alias(number, "text"))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(mixed.schema["n_chars"].dataType))
    return rows.select(*columns, number)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM s),
p AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
         coalesce(sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {MAX_EPOCHS}::DOUBLE AS before,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM o),
f AS (SELECT total - before AS left_words, rest AS left_weight FROM p
      WHERE weight * (total - before) / rest <= source_size * {MAX_EPOCHS}::DOUBLE ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(weight * left_words / left_weight, (source_size * {MAX_EPOCHS})::DOUBLE) AS target
      FROM s CROSS JOIN f),
r AS (
  SELECT doc_id, size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{SEED}:round:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u1,
         ('0x' || substr(md5('{SEED}:start:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u2
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, floor(rate)::BIGINT AS whole, least(size, floor((rate - floor(rate)) * size + u1)::BIGINT) AS part_words FROM r)
SELECT doc_id, size, source_size, target, whole * size + part_words AS taken, whole, part_words,
       floor(u2 * (size - part_words + 1))::BIGINT AS part_start
FROM q
"""
