"""Scoring a run against gold labels: coverage, confusion matrix,
per-class precision/recall/F1, accuracy, macro-F1, latency/throughput,
ROC/AUC and binary metrics. Rates and scores are rounded as the report
shows them (4 dp; latencies 1 dp)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.functions.numeric import safe_div
from moodstream.functions.time import epoch_micros
from moodstream.operators.dashboard import version_list
from moodstream.plans.ordered import ordered_suffix_scan, percentiles_of_columns
from moodstream.plans.scalar import attach_row
from moodstream.schemas import LABELS
from moodstream.session import checkpoint_dir


def one_gold_label(gold: DataFrame, order_col: str | None = None) -> DataFrame:
    """``id, label`` with one row per id: of a repeated id the last by
    ``order_col``, or the last label by name when there is no order."""
    return gold.groupBy("id").agg(F.max_by("label", order_col if order_col else "label").alias("label"))


def match_gold(joined: DataFrame, gold: DataFrame, source: str | None = None,
               key_col: str = "source_id", order_col: str | None = None) -> DataFrame:
    """Joined rows that have a gold label (``gold_label`` added), optionally
    for one run tag only. Many joined rows may match one gold id. Gold is
    first reduced to one label per id (``one_gold_label``); the join is left
    to AQE (gold is often small enough to broadcast, and AQE checks that at
    run time)."""
    rows = joined if source is None else joined.where(F.col("source") == F.lit(source))
    g = one_gold_label(gold, order_col).select(F.col("id").alias("_gid"), F.col("label").alias("gold_label"))
    return rows.join(g, rows[key_col] == g["_gid"], "inner").drop("_gid")


def coverage(joined: DataFrame, gold: DataFrame, matched: DataFrame,
             key_col: str = "source_id") -> DataFrame:
    """One row: ``expected`` (distinct gold ids), ``joined`` rows, ``matched``
    rows and ``missing`` gold ids with no matched row (anti join)."""
    ids = gold.select(F.col("id").alias("_gid")).distinct()
    seen = matched.select(F.col(key_col).alias("_gid")).distinct()
    missing = ids.join(seen, "_gid", "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    parts = [ids.agg(F.count(F.lit(1)).alias("expected")), joined.agg(F.count(F.lit(1)).alias("joined")),
             matched.agg(F.count(F.lit(1)).alias("matched")), missing]
    out = parts[0]
    for p in parts[1:]:
        out = attach_row(out, p)
    return out


def confusion_matrix(pairs: DataFrame, gold_col: str = "gold_label", pred_col: str = "label",
                     labels: list[str] = LABELS) -> DataFrame:
    """``gold, pred, n`` for every label pair (zeros included). A label
    outside the domain stops the job with an error."""
    dom = F.array(*[F.lit(x) for x in labels])
    checked = pairs.select(
        F.when(F.array_contains(dom, F.col(gold_col)) & F.array_contains(dom, F.col(pred_col)),
               F.col(gold_col))
        .otherwise(F.raise_error(F.concat(F.lit("label outside "), F.lit(",".join(labels)), F.lit(": "),
                                          F.coalesce(F.col(gold_col), F.lit("null")), F.lit("/"),
                                          F.coalesce(F.col(pred_col), F.lit("null"))))).alias("gold"),
        F.col(pred_col).alias("pred"))
    counts = checked.groupBy("gold", "pred").agg(F.count(F.lit(1)).alias("n"))
    grid = counts.sparkSession.createDataFrame([(g, p) for g in labels for p in labels], "gold string, pred string")
    return F.broadcast(grid).join(counts, ["gold", "pred"], "left") \
        .select("gold", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def class_metrics(confusion: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """``label, precision, recall, f1, support`` (0 where undefined, 4 dp).
    Input is the small label×label confusion table."""
    c = confusion.select("*", F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"))
    agg = c.groupBy("label").agg(
        F.sum(F.when((F.col("gold") == F.col("label")) & (F.col("pred") == F.col("label")), F.col("n"))
              .otherwise(0)).alias("tp"),
        F.sum(F.when((F.col("gold") != F.col("label")) & (F.col("pred") == F.col("label")), F.col("n"))
              .otherwise(0)).alias("fp"),
        F.sum(F.when((F.col("gold") == F.col("label")) & (F.col("pred") != F.col("label")), F.col("n"))
              .otherwise(0)).alias("fn"))
    p = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    r = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    m = agg.select("label", p.alias("_p"), r.alias("_r"), (F.col("tp") + F.col("fn")).cast("long").alias("support"))
    f1 = safe_div(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r"))
    return m.select("label", F.round("_p", 4).alias("precision"), F.round("_r", 4).alias("recall"),
                    F.round(f1, 4).alias("f1"), "support")


def _label_counts(confusion: DataFrame, labels: list[str]) -> DataFrame:
    """One row: ``n``, ``ok`` and tp/fp/fn per label, in one pass."""
    n, hit = F.col("n"), F.col("gold") == F.col("pred")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long")
    cols = [total(F.lit(True)).alias("n"), total(hit).alias("ok")]
    for i, lab in enumerate(labels):
        gold, pred = F.col("gold") == lab, F.col("pred") == lab
        cols += [total(gold & pred).alias(f"tp{i}"), total(~gold & pred).alias(f"fp{i}"), total(gold & ~pred).alias(f"fn{i}")]
    return confusion.agg(*cols)


def _scores(i: int) -> tuple:
    tp, fp, fn = (F.col(f"{k}{i}") for k in ("tp", "fp", "fn"))
    p, r = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    return p, r, safe_div(2 * p * r, p + r), tp + fn


def summary(confusion: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """``n, accuracy, macro_f1``; macro-F1 averages the rounded per-class F1
    over all labels. One pass over the confusion table."""
    c = _label_counts(confusion, labels)
    macro = sum((F.round(_scores(i)[2], 4) for i in range(len(labels))), F.lit(0.0)) / F.lit(len(labels))
    return c.select("n", F.round(safe_div(F.col("ok"), F.col("n")), 4).alias("accuracy"), F.round(macro, 4).alias("macro_f1"))


def classification_report(confusion: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """``label, precision, recall, f1, support``, unrounded: a row per label,
    then ``macro avg`` and ``weighted avg``."""
    c = _label_counts(confusion, labels)
    per = [_scores(i) for i in range(len(labels))]
    support = sum((s[3] for s in per), F.lit(0))
    rows = [(lab, *s) for lab, s in zip(labels, per, strict=True)]
    macro = [sum((s[k] for s in per), F.lit(0.0)) / F.lit(len(labels)) for k in range(3)]
    weighted = [safe_div(sum((s[k] * s[3] for s in per), F.lit(0.0)), support) for k in range(3)]
    rows += [("macro avg", *macro, support), ("weighted avg", *weighted, support)]
    return c.select(F.inline(F.array(*[F.struct(
        F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.cast("long").alias("support"))
        for name, p, r, f, s in rows])))


def weighted_f1(confusion: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """Support-weighted average F1, 4 dp."""
    return classification_report(confusion, labels).where(F.col("label") == "weighted avg").select(F.round("f1", 4).alias("weighted_f1"))


def model_versions(rows: DataFrame, version_col: str = "model_version") -> DataFrame:
    """One row: sorted distinct non-empty versions of the matched rows."""
    return version_list(rows.where(F.col(version_col) != ""), version_col)


def evaluation_report(joined: DataFrame, gold: DataFrame, source: str | None = None, key_col: str = "source_id",
                      labels: list[str] = LABELS, order_col: str | None = None) -> DataFrame:
    """The whole report of a run as one row: ``coverage`` counts of the
    (tagged) rows, ``model_versions``, quality (``n, accuracy, macro_f1,
    per_class, confusion``) and ``performance`` of the matched rows. The
    matched rows are checkpointed once for all parts."""
    checkpoint_dir(joined.sparkSession)
    rows = joined if source is None else joined.where(F.col("source") == F.lit(source))
    matched = match_gold(rows, gold, key_col=key_col, order_col=order_col).checkpoint()
    cm = confusion_matrix(matched, labels=labels).checkpoint()
    per = _label_counts(cm, labels).select(F.array(*[F.struct(
        F.lit(lab).alias("label"), F.round(_scores(i)[0], 4).alias("precision"), F.round(_scores(i)[1], 4).alias("recall"),
        F.round(_scores(i)[2], 4).alias("f1"), _scores(i)[3].alias("support")) for i, lab in enumerate(labels)]).alias("per_class"))
    cells = cm.agg(*[F.max(F.when((F.col("gold") == g) & (F.col("pred") == p), F.col("n"))).alias(f"c{i}_{j}")
                     for i, g in enumerate(labels) for j, p in enumerate(labels)])
    cells = cells.select(F.array(*[F.array(*[F.col(f"c{i}_{j}") for j in range(len(labels))]) for i in range(len(labels))]).alias("confusion"))
    out = coverage(rows, gold, matched, key_col)
    for part in (model_versions(matched), summary(cm, labels), per, cells, performance(matched)):
        out = attach_row(out, part)
    return out


def _number(col):
    """A rounded number as it is usually shown: no trailing zeros but one."""
    text = F.regexp_replace(F.col(col).cast("decimal(30,2)").cast("string"), "0$", "")
    return F.coalesce(text, F.lit("None"))


def report_lines(report: DataFrame) -> DataFrame:
    """The report as Markdown: ``line_no, line``, labels in their fixed
    order."""
    f4 = lambda c: F.format_string("%.4f", c)
    head = [
        F.concat(F.lit("Matched "), F.col("matched").cast("string"), F.lit(" / "), F.col("expected").cast("string"), F.lit(" dataset rows ("),
                 F.col("missing").cast("string"), F.lit(" missing) · model: "),
                 F.when(F.size("model_versions") > 0, F.array_join("model_versions", ", ")).otherwise(F.lit("n/a"))),
        F.lit(""), F.lit("| Metric | Value |"), F.lit("|---|---|"),
        F.concat(F.lit("| Accuracy | "), f4(F.col("accuracy")), F.lit(" |")),
        F.concat(F.lit("| Macro-F1 | "), f4(F.col("macro_f1")), F.lit(" |")),
    ]
    classes = F.transform("per_class", lambda c: F.concat(
        F.lit("| F1 "), c["label"], F.lit(" (n="), c["support"].cast("string"), F.lit(") | "), f4(c["f1"]), F.lit(" |")))
    show = lambda name, *cols: F.concat(F.lit(f"| {name} | "), F.concat_ws(" / ", *[_number(c) for c in cols]))
    tail = [
        F.concat(show("Offered rate", "offered_rate_per_sec"), F.lit(" msg/s |")),
        F.concat(show("Throughput (end to end)", "throughput_per_sec"), F.lit(" msg/s |")),
        F.concat(show("Produce→predict p50 / p95", "produce_to_predict_p50", "produce_to_predict_p95"), F.lit(" ms |")),
        F.concat(show("Produce→join p50 / p95 / p99", "produce_to_join_p50", "produce_to_join_p95", "produce_to_join_p99"), F.lit(" ms |")),
    ]
    lines = F.concat(F.array(*head), classes, F.array(*tail))
    return report.select(F.posexplode(lines).alias("line_no", "line"))


def performance(rows: DataFrame) -> DataFrame:
    """Offered rate ``n / (max − min produced_at)``, throughput
    ``n / (max joined_at − min produced_at)``, wall seconds, and exact
    p50/p95/p99/max of produce→predict and produce→join (ms, 1 dp).

    The narrow projection needed by every figure is checkpointed once, so
    the (possibly join-heavy) input is computed a single time."""
    checkpoint_dir(rows.sparkSession)
    rows = rows.select(F.col("produced_at").cast("timestamp").alias("produced_at"),
                       F.col("predicted_at").cast("timestamp").alias("predicted_at"),
                       F.col("joined_at").cast("timestamp").alias("joined_at"),
                       F.col("end_to_end_ms").cast("double").alias("end_to_end_ms")).checkpoint(eager=True)
    base = rows.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count("produced_at").alias("_np"), F.count("joined_at").alias("_nj"),
        F.min(epoch_micros("produced_at")).alias("_p0"), F.max(epoch_micros("produced_at")).alias("_p1"),
        F.max(epoch_micros("joined_at")).alias("_j1"))
    span = (F.col("_p1") - F.col("_p0")) / 1e6
    wall = (F.col("_j1") - F.col("_p0")) / 1e6
    base = base.select(
        "messages",
        F.when((F.col("_np") > 1) & (span > 0), F.round(F.col("messages") / span, 2)).alias("offered_rate_per_sec"),
        F.when((F.col("_np") > 0) & (F.col("_nj") > 0) & (wall > 0), F.round(F.col("messages") / wall, 2))
        .alias("throughput_per_sec"),
        F.when((F.col("_np") > 0) & (F.col("_nj") > 0), F.round(wall, 1)).alias("wall_seconds"))
    lat = rows.select(((epoch_micros("predicted_at") - epoch_micros("produced_at")) / 1000.0).alias("predict_ms"),
                      F.col("end_to_end_ms").alias("join_ms"))
    names = {f"{name}_p{int(q * 100)}": (col, q) for col, name in
             (("predict_ms", "produce_to_predict"), ("join_ms", "produce_to_join")) for q in (0.5, 0.95, 0.99)}
    pr = percentiles_of_columns(lat, names)
    pr = pr.select(*[F.round(c, 1).alias(c) for c in pr.columns])
    mx = lat.agg(F.round(F.max("predict_ms"), 1).alias("produce_to_predict_max"),
                 F.round(F.max("join_ms"), 1).alias("produce_to_join_max"))
    return attach_row(attach_row(base, pr), mx)


def roc_points(df: DataFrame, score_col: str, label_col: str,
               num_partitions: int | None = None) -> DataFrame:
    """ROC curve: one point per distinct score (as threshold, ``score ≥ t``
    is positive) plus the origin: ``threshold, tpr, fpr``. Cumulative counts
    come from the distributed ordered scan over the distinct scores."""
    g = df.groupBy(F.col(score_col).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label_col) == 1).cast("long").alias("_pos"),
        F.count_if(F.col(label_col) != 1).cast("long").alias("_neg"))
    tot = g.agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    s = ordered_suffix_scan(g, ["threshold"], ["_pos", "_neg"], num_partitions=num_partitions)
    pts = attach_row(s, tot).select(
        "threshold", safe_div(F.col("suf__pos"), F.col("_P")).alias("tpr"),
        safe_div(F.col("suf__neg"), F.col("_N")).alias("fpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, tpr double, fpr double")
    return pts.unionByName(origin)


def roc_auc(df: DataFrame, score_col: str, label_col: str,
            num_partitions: int | None = None) -> DataFrame:
    """Area under the ROC curve (trapezoids), computed as the tie-corrected
    Mann–Whitney statistic: Σ_g pos_g·(neg below g + ½·neg_g) / (P·N)."""
    g = df.groupBy(F.col(score_col).cast("double").alias("_s")).agg(
        F.count_if(F.col(label_col) == 1).cast("long").alias("_pos"),
        F.count_if(F.col(label_col) != 1).cast("long").alias("_neg"))
    s = ordered_suffix_scan(g, ["_s"], ["_neg"], num_partitions=num_partitions)
    return auc_of(s)


def auc_of(s: DataFrame) -> DataFrame:
    """AUC of ``_pos, _neg, suf__neg`` rows, one per distinct score."""
    # Products of counts outgrow BIGINT at some 10^9 rows a class: 38 digits hold them exactly.
    big = lambda c: F.col(c).cast("decimal(19,0)")
    part = s.agg(F.sum(big("_pos") * (big("suf__neg") - big("_neg")).cast("decimal(19,0)")).alias("_above"),
                 F.sum(big("_pos") * big("_neg")).alias("_ties"),
                 F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    # suf__neg - _neg = negatives strictly above; below = N - suffix
    pairs, d = F.col("_P").cast("double") * F.col("_N").cast("double"), lambda c: F.col(c).cast("double")
    return part.select(safe_div(pairs - d("_above") - F.lit(0.5) * d("_ties"), pairs).alias("auc"))


def binary_metrics(df: DataFrame, prob_col: str, label_col: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy and F1 of ``prob ≥ threshold`` (class 1) against 0/1 labels."""
    pred = F.when(F.col(prob_col) < F.lit(threshold), F.lit(0)).otherwise(F.lit(1))
    y = F.col(label_col)
    a = df.agg(F.count(F.lit(1)).alias("n"),
               F.count_if(pred == y).alias("_ok"),
               F.count_if((pred == 1) & (y == 1)).alias("tp"),
               F.count_if((pred == 1) & (y != 1)).alias("fp"),
               F.count_if((pred != 1) & (y == 1)).alias("fn"))
    return a.select("n", safe_div(F.col("_ok"), F.col("n")).alias("accuracy"),
                    safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))
