"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

A source that holds share p of the text and has target weight w is to be seen
epochs * w / p times on average. Each document draws a uniform number from the
MD5 of its id and the seed, inverts the Poisson distribution of that mean, and is
exploded into so many copies. Copies are dealt over the partitions, and ordered
within them, by a second hash, which is a global shuffle.

Without explicit weights the target of a source is its share to the power
``temper``, normalised; sources that explicit weights do not name get weight zero
and leave the mix.

A mean above STEP is drawn as a sum of equal smaller Poisson draws, so the table of
limits that is inverted has the same length at any rate. The default weights serve
every rate, however small a source's share; explicit weights are bound by ``most_rate``.

Defined cases: null sources form one source of their own; a null doc_id draws by
its text; a null or empty text counts zero characters and, where a whole source is
empty, has rate one; repeated rows draw alike; an empty table gives no row. Output
columns are those of docs, then, if ``told``, those of ``ADDED`` (a column of docs by
such a name is replaced). Columns of any other name pass unharmed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest mean inverted in one draw, and the counts that one draw can give: P(X > TERMS) is under 1e-15 at STEP.
STEP, TERMS = 2.0, 21
ADDED = ("copy", "repetition_rate", "shuffle_key")


def hash_unit(text: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_limits(mean: Column) -> Column:
    """P(X <= k) for k from 0 of a Poisson variable: a uniform number's count is how many of these it is not under."""
    term = lambda j: F.exp(-mean) * F.pow(mean, j) / F.factorial(j).cast("double")
    upto = lambda k: F.aggregate(F.sequence(F.lit(0), k), F.lit(0.0), lambda held, j: held + term(j))
    return F.transform(F.sequence(F.lit(0), F.lit(TERMS - 1)), lambda k: F.round(upto(k), 12))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temper: float = 0.7, epochs: float = 1.0) -> DataFrame:
    """mix_source, rate, draws (Poisson variables of mean rate / draws that make up one of mean rate) and their limits, one row per source."""
    sized = docs.groupBy(F.coalesce("source", F.lit("")).alias("mix_source")).agg(
        F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("chars")
    )
    total = sized.agg(F.sum("chars").alias("total"))
    shares = sized.crossJoin(F.broadcast(total)).select("mix_source", (F.col("chars") / F.col("total")).alias("share"))
    if weights is None:
        target = F.when(F.col("share") > 0, F.pow("share", F.lit(temper)))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        target = F.coalesce(F.create_map(*pairs)[F.col("mix_source")], F.lit(0.0))
    shares = shares.withColumn("target", F.coalesce(target, F.lit(0.0)))
    whole = shares.where("share > 0").agg(F.sum("target").alias("whole"))
    rate = F.when(F.col("share") > 0, F.lit(float(epochs)) * F.col("target") / F.col("whole") / F.col("share")).otherwise(1.0)
    rated = shares.crossJoin(F.broadcast(whole)).select("mix_source", F.round(F.coalesce(rate, F.lit(1.0)), 9).alias("rate"))
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(STEP))).cast("int")
    return rated.withColumn("draws", draws).withColumn("limits", poisson_limits(F.col("rate") / F.col("draws")))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temper: float = 0.7,
    epochs: float = 1.0,
    seed: str = "mix-1",
    most_rate: float = 64.0,
    most_sources: int = 100_000,
    told: bool = True,
) -> DataFrame:
    """docs replicated towards the target weights and globally shuffled, with copy, repetition_rate and shuffle_key if ``told``.

    With explicit weights, a rate above most_rate raises an error, since such a source cannot fill its target by repetition in good sense.
    """
    rates = source_rates(docs, weights, temper, epochs)
    count, highest = rates.agg(F.count("*"), F.max("rate")).first()
    if weights is not None and highest is not None and highest > most_rate:
        raise ValueError(f"a source would be repeated {highest} times; the limit is {most_rate}")
    rates = F.broadcast(rates) if count <= most_sources else rates
    base = docs.drop(*ADDED).columns if told else docs.columns
    # a row travels as one struct, so no column of docs can meet a name of this function
    named = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{x}`") for x in base]).alias("row"), named.alias("named"), F.coalesce("source", F.lit("")).alias("mix_source"))
    turns = F.sequence(F.lit(1), F.col("draws"))
    uniforms = F.transform(turns, lambda k: hash_unit(F.concat_ws("|", F.lit(seed), k.cast("string"), F.col("named"))))
    times = F.aggregate(uniforms, F.lit(0), lambda held, u: held + F.size(F.filter("limits", lambda below: u >= below)))
    copies = rows.join(rates, "mix_source").withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("copy").cast("string"), F.col("named")))
    out = copies.select("row", F.col("copy").cast("long").alias("copy"), F.col("rate").alias("repetition_rate"), key.alias("shuffle_key"))
    dealt = out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.select(*[F.col("row").getField(x).alias(x) for x in base], *(ADDED if told else ()))


def mix_sql(temper: float = 0.7, epochs: float = 1.0, seed: str = "mix-1", table: str = "documents", columns: str = "doc_id, text, lang, source, n_chars") -> str:
    """DuckDB SQL for ``mix`` without explicit weights."""
    named = "coalesce(doc_id::varchar, text, '')"
    u = f"(('0x' || substr(md5(concat_ws('|', '{seed}', turn::varchar, {named})), 1, 13))::bigint / {float(1 << 52)!r})"
    return f"""
WITH sized AS (SELECT coalesce(source, '') AS mix_source, sum(coalesce(length(text), 0)) AS chars FROM {table} GROUP BY 1),
shares AS (SELECT mix_source, chars::double / (SELECT sum(chars) FROM sized)::double AS share FROM sized),
rates AS (SELECT mix_source, round(CASE WHEN share > 0 THEN {epochs!r} * pow(share, {temper!r}) / (SELECT sum(pow(share, {temper!r})) FROM shares WHERE share > 0) / share ELSE 1.0 END, 9) AS rate FROM shares),
parts AS (SELECT *, rate / draws AS mean FROM (SELECT *, greatest(1, ceil(rate / {STEP!r})::integer) AS draws FROM rates)),
terms AS (SELECT mix_source, rate, draws, k, exp(-mean) * pow(mean, k) / factorial(k::integer)::double AS term FROM parts, range(0, {TERMS + 1}) AS t(k)),
steps AS (SELECT mix_source, rate, draws, k, sum(term) OVER (PARTITION BY mix_source ORDER BY k) AS below FROM terms),
limits AS (SELECT mix_source, rate, draws, list(round(below, 12) ORDER BY k) AS belows FROM steps WHERE k < {TERMS} GROUP BY ALL),
drawn AS (SELECT d.*, rate, list_sum(list_transform(range(1, draws + 1), lambda turn: len(list_filter(belows, lambda b: {u} >= b)))) AS times FROM {table} d JOIN limits ON coalesce(d.source, '') = mix_source)
SELECT {columns}, copy, rate AS repetition_rate, md5(concat_ws('|', '{seed}', copy::varchar, {named})) AS shuffle_key
FROM (SELECT *, unnest(range(1, times::bigint + 1)) AS copy FROM drawn WHERE times > 0)"""
