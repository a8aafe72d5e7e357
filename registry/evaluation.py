"""Reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import derive, query, table
from turnwise.operators import evaluation

# Two sets of predictions: rules on the length of a text, with a label one of them never gives.
JUDGED = """
SELECT l.doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'poor' END AS actual,
  CASE WHEN n_chars > 3000 THEN 'good' WHEN n_chars % 5 = 0 THEN 'toxic' ELSE 'poor' END AS first_model,
  CASE WHEN n_chars > 1500 THEN 'good' WHEN n_chars % 7 = 0 THEN 'spam' ELSE 'poor' END AS second_model
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id
"""
# A skewed pair of labels from a large table: one label holds most rows.
LINES = """
SELECT CASE WHEN l_quantity > 20 THEN 'bulk' WHEN l_quantity > 10 THEN 'some' ELSE 'few' END AS actual,
  CASE WHEN l_extendedprice > 30000 THEN 'bulk' WHEN l_extendedprice > 10000 THEN 'some' WHEN l_returnflag = 'R' THEN CAST(NULL AS STRING)
    ELSE 'few' END AS predicted FROM {lineitem}
"""


def report_sql(rows: str, predicted: str) -> str:
    return f"""
WITH r AS (SELECT actual, {predicted} AS predicted FROM ({rows}) WHERE actual IS NOT NULL AND {predicted} IS NOT NULL),
names AS (SELECT actual AS label FROM r UNION SELECT predicted FROM r),
s AS (SELECT label, (SELECT count(*) FROM r WHERE actual = label) AS support,
  (SELECT count(*) FROM r WHERE predicted = label) AS guessed,
  (SELECT count(*) FROM r WHERE predicted = label AND actual = label) AS hits FROM names),
m AS (SELECT label, support, hits, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS p,
  CASE WHEN support > 0 THEN hits / support ELSE 0 END AS q, 2 * hits / (guessed + support) AS f FROM s)
SELECT label, p AS precision, q AS recall, f AS "f1-score", CAST(support AS DOUBLE) AS support FROM m
UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM m
UNION ALL SELECT 'macro avg', avg(p), avg(q), avg(f), sum(support) FROM m
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(q * support) / sum(support),
  sum(f * support) / sum(support), sum(support) FROM m"""


def rounded_sql(rows: str, predicted: str) -> str:
    return f"""SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round("f1-score", 6) AS "f1-score", support FROM ({report_sql(rows, predicted)})"""


def rounded(report):
    scores = ["precision", "recall", "f1-score"]
    return report.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in scores})


@query("classification_report", rounded_sql(JUDGED, "first_model"))
def _(spark, sf):
    rows = derive(spark, sf, JUDGED)
    return rounded(evaluation.classification_report(rows, "actual", "first_model"))


@query("classification_report_lines", rounded_sql(LINES, "predicted"))
def _(spark, sf):
    rows = derive(spark, sf, LINES)
    return rounded(evaluation.classification_report(rows, "actual", "predicted"))


@query("confusion_matrix", f"""
SELECT actual, predicted, count(*) AS n FROM ({LINES}) WHERE predicted IS NOT NULL GROUP BY ALL
""")
def _(spark, sf):
    return evaluation.confusion_matrix(derive(spark, sf, LINES), "actual", "predicted")


@query("wide_confusion", f"""
SELECT actual AS label, count(*) FILTER (predicted = 'bulk') AS bulk, count(*) FILTER (predicted = 'few') AS few,
  count(*) FILTER (predicted = 'some') AS some FROM ({LINES}) GROUP BY actual
""")
def _(spark, sf):
    pairs = evaluation.confusion_matrix(derive(spark, sf, LINES), "actual", "predicted")
    return evaluation.wide_confusion(pairs, ["bulk", "few", "some"])


@query("order_report", f"""
SELECT label, round(precision, 6) AS precision, row_number() OVER (ORDER BY CASE label WHEN 'accuracy' THEN 1
  WHEN 'macro avg' THEN 2 WHEN 'weighted avg' THEN 3 ELSE 0 END, label) AS place
FROM ({report_sql(JUDGED, 'second_model')})
""")
def _(spark, sf):
    report = evaluation.classification_report(derive(spark, sf, JUDGED), "actual", "second_model")
    ordered = evaluation.order_report(report)
    # A sorted report keeps its order in the partition numbers and the rows inside them.
    place = F.monotonically_increasing_id() + 1
    return ordered.coalesce(1).select(
        "label", F.round("precision", 6).alias("precision"), place.alias("place")
    )


@query("compare_classification_reports", f"""
SELECT label, round(a.precision, 6) AS precision_1, round(b.precision, 6) AS precision_2,
  round(a.recall, 6) AS recall_1, round(b.recall, 6) AS recall_2, round(a."f1-score", 6) AS f1_1,
  round(b."f1-score", 6) AS f1_2, a.support AS support_1, b.support AS support_2
FROM ({report_sql(JUDGED, 'first_model')}) a FULL JOIN ({report_sql(JUDGED, 'second_model')}) b USING (label)
""")
def _(spark, sf):
    rows = derive(spark, sf, JUDGED)
    both = evaluation.compare_classification_reports(
        evaluation.classification_report(rows, "actual", "first_model"),
        evaluation.classification_report(rows, "actual", "second_model"),
    )
    pair = lambda m, short: [
        F.round(F.col(f"`{m}`.{side}"), 6).alias(f"{short}_{i}")
        for i, side in ((1, "first"), (2, "second"))
    ]
    return both.select(
        "label", *pair("precision", "precision"), *pair("recall", "recall"),
        *pair("f1-score", "f1"), *pair("support", "support"),
    )


@query("compare_confusion", f"""
WITH r AS ({JUDGED}), x AS (SELECT actual, first_model AS predicted, count(*) AS n FROM r GROUP BY ALL),
y AS (SELECT actual, second_model AS predicted, count(*) AS n FROM r GROUP BY ALL),
kx AS (SELECT actual AS label FROM x UNION SELECT predicted FROM x),
ky AS (SELECT actual AS label FROM y UNION SELECT predicted FROM y)
SELECT actual, predicted, coalesce(x.n, CASE WHEN actual IN (FROM kx) AND predicted IN (FROM kx) THEN 0 END) AS first,
  coalesce(y.n, CASE WHEN actual IN (FROM ky) AND predicted IN (FROM ky) THEN 0 END) AS second
FROM x FULL JOIN y USING (actual, predicted)
""")
def _(spark, sf):
    rows = derive(spark, sf, JUDGED)
    return evaluation.compare_confusion(
        evaluation.confusion_matrix(rows, "actual", "first_model"),
        evaluation.confusion_matrix(rows, "actual", "second_model"),
    )


@query("label_union", f"""
SELECT first_model AS label FROM ({JUDGED}) UNION SELECT second_model FROM ({JUDGED})
""")
def _(spark, sf):
    rows = derive(spark, sf, JUDGED)
    a = rows.select(F.col("first_model").alias("label"))
    return evaluation.label_union(a, rows.select(F.col("second_model").alias("label")))


# What was said against what was heard: each turn beside the next one of its call, and a copy of
# each turn with some words changed. Both texts are whole.
HEARD = """
SELECT a.conv_id * 100 + a.turn AS id, a.text AS transcript_y,
  CASE WHEN a.turn % 5 = 4 THEN CAST(NULL AS STRING) WHEN a.turn % 2 = 0 THEN replace(replace(a.text, ' de ', ' '), ' the ', ' a the ')
    ELSE b.text END AS heard
FROM {conversations} a LEFT JOIN {conversations} b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
"""
HEARD_SQL = f"""
SELECT id, list_filter(regexp_split_to_array(transcript_y, '\\s+'), lambda w: w <> '') AS ref,
  list_filter(regexp_split_to_array(coalesce(heard, ''), '\\s+'), lambda w: w <> '') AS hyp FROM ({HEARD})
"""
# One step per reference word. An insertion costs one everywhere, so a whole table row is a running minimum.
DISTANCE_SQL = f"""
WITH RECURSIVE t AS (SELECT id, 0 AS i, ref, hyp, range(0, len(hyp) + 1) AS d FROM ({HEARD_SQL})
UNION ALL
SELECT id, i + 1, ref, hyp, list_transform(range(1, len(b) + 1), lambda j:
  j - 1 + list_min(b[1:j])) FROM (
    SELECT id, i, ref, hyp, list_transform(range(1, len(d) + 1), lambda j: CASE WHEN j = 1 THEN d[1] + 1 ELSE
      least(d[j] + 1, d[j - 1] + CASE WHEN ref[i + 1] = hyp[j - 1] THEN 0 ELSE 1 END) END - (j - 1)) AS b
    FROM t WHERE i < len(ref)))
SELECT id, len(ref) AS ref_words, len(hyp) AS hyp_words, d[len(d)] AS errors FROM t WHERE i = len(ref)
"""


def heard(spark, sf):
    rows = derive(spark, sf, HEARD)
    said = F.transform(F.array("heard"), lambda h: F.struct(h.alias("transcript")))
    listed = F.when(F.col("heard").isNotNull(), F.to_json(F.array(said)))
    return rows.select("id", "transcript_y", listed.alias("utterances"))


@query("asr_breakdown", f"""
SELECT id, ref_words, hyp_words, errors, round(errors / nullif(ref_words, 0), 6) AS wer FROM ({DISTANCE_SQL})
""")
def _(spark, sf):
    breakdown = evaluation.asr_breakdown(evaluation.asr_pairs(heard(spark, sf)))
    return breakdown.withColumn("wer", F.round("wer", 6))


@query("asr_report", f"""
SELECT count(*) AS rows, CAST(sum(ref_words) AS BIGINT) AS ref_words, CAST(sum(errors) AS BIGINT) AS errors,
  round(sum(errors) / sum(ref_words), 6) AS wer FROM ({DISTANCE_SQL})
""")
def _(spark, sf):
    report, _, _ = evaluation.asr_report(heard(spark, sf))
    return report.withColumn("wer", F.round("wer", 6))


# Which words are aligned is not unique, but these two sums are.
@query("asr_operations", f"""
SELECT id, errors, ref_words - hyp_words AS more_deletions, ref_words FROM ({DISTANCE_SQL})
""")
def _(spark, sf):
    _, _, ops = evaluation.asr_report(heard(spark, sf))
    return ops.select(
        "id",
        F.expr("insertions + deletions + substitutions").alias("errors"),
        F.expr("deletions - insertions").alias("more_deletions"),
        F.expr("hits + substitutions + deletions").alias("ref_words"),
    )
