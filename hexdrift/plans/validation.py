"""Queries that hold scores against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources import model as M

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Scored rows: label, flag and a score in steps of 1/200 with many ties.
SQL = """WITH v AS (SELECT doc_id, lang, source, toxic AS label, (n_chars % 200) / 200e0 AS score, n_chars % 200 >= 100 AS flag
  FROM labels JOIN documents USING (doc_id)),
by_score AS (SELECT score, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM v GROUP BY score),
curve AS (SELECT score, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n - pos) OVER w AS BIGINT) AS fp, CAST(sum(pos) OVER () AS BIGINT) AS positives, pos FROM by_score WINDOW w AS (ORDER BY score DESC))
"""


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that checks it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = SQL + sql
        return f

    return add


def rows(spark, d) -> DataFrame:
    """doc_id, lang, source, label, score, flag."""
    docs = M.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    rest = F.col("n_chars") % 200
    v = M.table(spark, d, "labels").join(docs, "doc_id")
    return v.select("doc_id", "lang", "source", F.col("toxic").alias("label"), (rest / F.lit(200.0)).alias("score"), (rest >= 100).alias("flag"))


def confusion(flag, label):
    """tp, fp, tn, fn of a flag."""
    hit = label == 1
    return [F.count_if(flag & hit).alias("tp"), F.count_if(flag & ~hit).alias("fp"), F.count_if(~flag & ~hit).alias("tn"), F.count_if(~flag & hit).alias("fn")]


def ratio(a, b):
    """a / b, 0 where b is."""
    return F.when(b > 0, a / F.nullif(b, F.lit(0))).otherwise(F.lit(0.0))


def metrics(df: DataFrame) -> DataFrame:
    """precision, recall and f1 next to the counts."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return df.withColumn("precision", F.round(ratio(tp, tp + fp), 6)).withColumn("recall", F.round(ratio(tp, tp + fn), 6)).withColumn("f1", F.round(ratio(2 * tp, 2 * tp + fp + fn), 6))


_CONF = "count(*) FILTER (WHERE {f} AND label = 1) AS tp, count(*) FILTER (WHERE {f} AND label <> 1) AS fp, count(*) FILTER (WHERE NOT {f} AND label <> 1) AS tn, count(*) FILTER (WHERE NOT {f} AND label = 1) AS fn"
_METRIC = "CASE WHEN tp + fp > 0 THEN round(tp / CAST(tp + fp AS DOUBLE), 6) ELSE 0e0 END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / CAST(tp + fn AS DOUBLE), 6) ELSE 0e0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) ELSE 0e0 END AS f1"


@query("a16_confusion", f"SELECT *, {_METRIC} FROM (SELECT {_CONF.format(f='flag')} FROM v)")
def _(spark, d):
    return metrics(rows(spark, d).agg(*confusion(F.col("flag"), F.col("label"))))


@query("a17_strata", f"SELECT lang, source, {_METRIC} FROM (SELECT lang, source, {_CONF.format(f='flag')} FROM v GROUP BY GROUPING SETS ((lang), (source))) WHERE tp + fn > 0 OR tp + fp > 0")
def _(spark, d):
    g = rows(spark, d).groupingSets([[F.col("lang")], [F.col("source")]], F.col("lang"), F.col("source")).agg(*confusion(F.col("flag"), F.col("label")))
    return metrics(g.where("tp + fn > 0 OR tp + fp > 0")).select("lang", "source", "precision", "recall", "f1")


@query("a18_fp_reasons", "SELECT source, count(*) AS n FROM v WHERE flag AND label = 0 GROUP BY source ORDER BY n DESC, source LIMIT 10")
def _(spark, d):
    return rows(spark, d).where("flag AND label = 0").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(10)


@query("a15_score_describe", "SELECT count(*) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS sd, min(score) AS low, round(quantile_cont(score, 0.25), 6) AS q25, round(median(score), 6) AS q50, round(quantile_cont(score, 0.75), 6) AS q75, max(score) AS high FROM v")
def _(spark, d):
    p = lambda q, n: F.round(F.percentile("score", q), 6).alias(n)
    return rows(spark, d).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.stddev_samp("score"), 6).alias("sd"), F.min("score").alias("low"), p(0.25, "q25"), p(0.5, "q50"), p(0.75, "q75"), F.max("score").alias("high"))


def curve(v: DataFrame) -> DataFrame:
    """tp and fp of each threshold; the window runs over distinct scores, not rows."""
    by = v.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    down = W.orderBy(F.desc("score"))
    return by.select("score", F.sum("pos").over(down).alias("tp"), F.sum(F.col("n") - F.col("pos")).over(down).alias("fp"), F.sum("pos").over(W.partitionBy()).alias("positives"), "pos")


@query("a20_pr_curve", "SELECT score, tp, fp, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(positives AS DOUBLE), 6) AS recall FROM curve")
def _(spark, d):
    tp, fp = F.col("tp"), F.col("fp")
    return curve(rows(spark, d)).select("score", "tp", "fp", F.round(tp / (tp + fp), 6).alias("precision"), F.round(ratio(tp, F.col("positives")), 6).alias("recall"))


@query("a20_average_precision", "SELECT round(sum(pos / CAST(positives AS DOUBLE) * tp / CAST(tp + fp AS DOUBLE)), 6) AS ap FROM curve")
def _(spark, d):
    return curve(rows(spark, d)).agg(F.round(F.sum(ratio(F.col("pos"), F.col("positives")) * F.col("tp") / (F.col("tp") + F.col("fp"))), 6).alias("ap"))


_CUTS = ", ".join(f"quantile_cont(score, {k / 10}) AS q{k}" for k in range(1, 10))


@query("a21_calibration", f"SELECT bin, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS positive, count(*) AS n FROM (SELECT v.*, CAST({' + '.join(f'CAST(score > q{k} AS INT)' for k in range(1, 10))} AS INT) AS bin FROM v, (SELECT {_CUTS} FROM v)) GROUP BY bin")
def _(spark, d):
    """Bins of about equal numbers of rows: their ends are the deciles; empty ones are left out."""
    v = rows(spark, d)
    cuts = v.agg(F.percentile("score", [k / 10 for k in range(1, 10)])).first()[0] or []
    bin_ = sum(((F.col("score") > c).cast("int") for c in cuts), F.lit(0))
    return v.withColumn("bin", bin_).groupBy("bin").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.round(F.avg("label"), 6).alias("positive"), F.count(F.lit(1)).alias("n"))


@query("a22_cost_threshold", "SELECT arg_min(score, (fp * 1e0 + (positives - tp) * 5e0, score)) AS threshold, min(fp * 1e0 + (positives - tp) * 5e0) AS cost FROM curve")
def _(spark, d):
    cost = F.col("fp") * F.lit(1.0) + (F.col("positives") - F.col("tp")) * F.lit(5.0)
    return curve(rows(spark, d)).agg(F.min_by("score", F.struct(cost.alias("c"), "score")).alias("threshold"), F.min(cost).alias("cost"))


@query("a23_baseline", f"SELECT *, {_METRIC} FROM (SELECT {_CONF.format(f='(score >= t)')} FROM v, (SELECT quantile_cont(score, 0.9) AS t FROM v))")
def _(spark, d):
    v = rows(spark, d)
    t = v.agg(F.percentile("score", 0.9)).first()[0] or 0.0
    return metrics(v.agg(*confusion(F.col("score") >= t, F.col("label"))))


@query("a24_sensitivity", "SELECT p, count(*) FILTER (WHERE score >= t) AS flagged, count(*) FILTER (WHERE score >= t AND label = 1) AS tp FROM v, (SELECT p, quantile_cont(score, p) AS t FROM v, (SELECT unnest([0.8e0, 0.85e0, 0.9e0, 0.95e0]) AS p) GROUP BY p) GROUP BY p".replace("quantile_cont(score, p)", "CASE p WHEN 0.8 THEN quantile_cont(score, 0.8) WHEN 0.85 THEN quantile_cont(score, 0.85) WHEN 0.9 THEN quantile_cont(score, 0.9) ELSE quantile_cont(score, 0.95) END"))
def _(spark, d):
    v = rows(spark, d)
    at = [0.8, 0.85, 0.9, 0.95]
    cuts = v.agg(F.percentile("score", at)).first()[0] or [0.0] * 4
    hit = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(t).alias("t")) for p, t in zip(at, cuts, strict=True)])
    g = v.select("score", "label", F.explode(hit).alias("c")).groupBy(F.col("c.p").alias("p"))
    on = F.col("score") >= F.col("c.t")
    return g.agg(F.count_if(on).alias("flagged"), F.count_if(on & (F.col("label") == 1)).alias("tp"))


@query("a29_benchmark_confusion", f"SELECT lang, tp, fp, tn, fn FROM (SELECT lang, {_CONF.format(f='flag')} FROM v GROUP BY lang)")
def _(spark, d):
    return rows(spark, d).groupBy("lang").agg(*confusion(F.col("flag"), F.col("label")))
