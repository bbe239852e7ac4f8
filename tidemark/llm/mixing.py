"""Mixing sources to target weights by Poisson replication (operator 4, DataFrame operations only).

Each source gets the repetition rate that brings its characters to its target
share; each document draws its number of copies from the Poisson distribution
of that rate, by inverting the distribution function at a hash of (seed,
doc_id, text); the copies are exploded and shuffled over all partitions by a
hash of (seed, document, copy).  Counts and statistics cover all documents.

The per-source table holds the distribution function as a list of cumulative
probabilities.  It is broadcast only where its measured bytes are below
``BROADCAST_BYTES``; otherwise the documents meet it in a join over
``SALTS`` slices of every source, so a source that holds a third of all rows
is split over as many tasks.

Defined results: a null source is a source of its own; null text counts as
empty; a source without any character gets rate 0, as does one with weight 0;
repeated rows (same doc_id and text) draw the same count, and their copies tie
in the global order, where equal rows are next to each other; texts of any
length are digested and carried whole; an empty table gives an empty result; other columns are carried through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ROW, materialise, packed, text_of

SEED = "tidemark-mix"
#: Without explicit weights a source's weight is its characters to this power.
ALPHA = 0.5
EPOCHS = 1.0
BROADCAST_BYTES = 8 << 20
SALTS = 64
_UNIT = float(1 << 52)


def _name(column: str) -> Column:
    """The source as a join key: 'n' for null, 's' before any other."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column)))


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, alpha: float = ALPHA, epochs: float = EPOCHS) -> DataFrame:
    """(source_key, rate): how often a document of the source should appear on average.

    ``weights`` gives explicit target weights (sources not named get 0).  The
    rate is weight share x all characters x epochs / characters of the source.
    """
    sizes = docs.groupBy(_name("source").alias("source_key")).agg(F.sum(F.length(text_of())).cast("double").alias("chars"))
    if weights is None:
        weight = F.pow("chars", F.lit(alpha))
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source_key") == ("n" if source is None else f"s{source}"), float(value)).otherwise(weight)
    sizes = materialise(sizes.withColumn("weight", F.when(F.col("chars") > 0, weight).otherwise(0.0)), "mix-sizes")
    total = sizes.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    if not total["weight"]:
        return sizes.select("source_key", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / F.lit(total["weight"]) * F.lit(total["chars"]) * epochs / F.col("chars")
    return sizes.select("source_key", F.when(F.col("weight") > 0, rate).otherwise(0.0).alias("rate"))


def cumulative(rate: Column) -> Column:
    """Cumulative Poisson probabilities P(N <= 0), P(N <= 1), ... far beyond the last that a 52-bit draw can reach.

    The terms are built up in logarithms, so rates in the hundreds do not underflow.
    """
    last = F.ceil(rate + 12.0 * F.sqrt(rate) + 30.0).cast("int")
    steps = F.sequence(F.lit(0), last)
    grown = F.aggregate(
        steps,
        F.struct(F.lit(0.0).alias("log_fact"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("out")),
        lambda s, k: F.struct(
            (s["log_fact"] + F.when(k > 0, F.ln(F.greatest(k, F.lit(1)).cast("double"))).otherwise(0.0)).alias("log_fact"),
            (s["sum"] + _term(rate, k, s["log_fact"])).alias("sum"),
            F.concat(s["out"], F.array(s["sum"] + _term(rate, k, s["log_fact"]))).alias("out"),
        ),
        lambda s: s["out"],
    )
    return F.when(rate > 0, grown).otherwise(F.array(F.lit(1.0)))


def _term(rate: Column, k: Column, log_fact: Column) -> Column:
    n = k.cast("double")
    return F.exp(n * F.ln(rate) - rate - log_fact - F.when(k > 0, F.ln(F.greatest(n, F.lit(1.0)))).otherwise(0.0))


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def _draw(hashed: Column) -> Column:
    """A number in [0, 1) of 52 bits."""
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / _UNIT


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    alpha: float = ALPHA,
    epochs: float = EPOCHS,
    seed: str = SEED,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` replicated to the target mix, in a global random order.

    Returns ``__row`` (the original row), ``copy`` (0, 1, ...), ``n_copies``
    and ``shuffle_key``; each partition is sorted by ``shuffle_key``, by whose
    hash the copies were dealt out.
    """
    rates = source_rates(docs, weights, alpha, epochs).withColumn("steps", cumulative(F.col("rate"))).drop("rate")
    rates = materialise(rates, "mix-rates")
    # Row-wise sizes of the written table: 8 bytes a step and the names.
    held = rates.agg(F.sum(F.size("steps") * 8 + F.octet_length("source_key") + 32)).first()[0] or 0
    rows = packed(
        docs,
        source_key=_name("source"),
        drawn=_hash(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_of().cast("binary"))),
    )
    if held <= broadcast_bytes:
        rows = rows.join(F.broadcast(rates), "source_key")
    else:
        salt = F.pmod(F.xxhash64("drawn"), F.lit(SALTS))
        sliced = rates.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        rows = rows.withColumn("salt", salt).join(sliced, ["source_key", "salt"])
    # The count is the number of cumulative probabilities at or below the draw.
    count = F.aggregate("steps", F.lit(0), lambda n, p: n + (p <= F.col("u")).cast("int"))
    rows = rows.withColumn("u", _draw(F.col("drawn"))).select(ROW, "drawn", count.alias("n_copies")).filter("n_copies > 0")
    copies = rows.select(ROW, "drawn", "n_copies", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"))
    keyed = copies.select(ROW, "copy", "n_copies", _hash(F.lit("order"), F.col("drawn"), F.col("copy").cast("string")).alias("shuffle_key"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS drawn
  FROM documents
), sizes AS (
  SELECT source, sum(length(body))::DOUBLE AS chars FROM d GROUP BY source
), w AS (
  SELECT source, chars, CASE WHEN chars > 0 THEN pow(chars, {ALPHA}) ELSE 0 END AS weight FROM sizes
), r AS (
  SELECT source, CASE WHEN weight > 0
    THEN weight / (SELECT sum(weight) FROM w) * (SELECT sum(chars) FROM w) * {EPOCHS} / chars ELSE 0 END AS rate FROM w
), p AS (
  SELECT source, k, sum(CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE 1 END)
    OVER (PARTITION BY source ORDER BY k) AS upto
  FROM r, range(0, 2000) AS s(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 30) AND (rate > 0 OR k = 0)
), n AS (
  SELECT doc_id, d.source, drawn, count(*) FILTER (WHERE p.upto <= ('0x' || substr(drawn, 1, 13))::BIGINT / {_UNIT!r}) AS n_copies
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source GROUP BY ALL
)
SELECT doc_id, source, copy::INTEGER AS copy, n_copies::INTEGER AS n_copies,
       md5(concat_ws('|', 'order', drawn, copy::VARCHAR)) AS shuffle_key
FROM n, LATERAL (SELECT unnest(range(0, n_copies)) AS copy)
"""
