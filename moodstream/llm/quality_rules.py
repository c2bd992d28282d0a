"""Quality rules whose cutoffs are set under a proven limit of false rejection.

A fixed base rule drops texts that are very short or mostly repeat themselves.
Beyond it, each learned rule compares one statistic of the text with a cutoff
of its own for each stratum (bands of the number of words unless another column
is given). A cutoff is used only if labelled holdouts prove, at confidence
``1 - error`` for all strata, rules and cutoffs together, that at most
``risk / rules`` of the stratum's good documents fall to it, so that all rules
together reject at most ``risk`` of them:

1. per stratum and rule, the cutoffs of a fixed ladder are tested from the
   loosest to the strictest against "the rate is above ``risk / rules``". The
   p-value is the exact binomial tail P(Bin(n, rate) <= k) for k of n good
   holdouts rejected; equivalently k must not exceed the largest count
   ``allowed`` whose tail is within the error;
2. testing stops at the first cutoff that fails (fixed sequence), so a ladder
   costs no error for its length; strata and rules share ``error`` in equal
   parts (Bonferroni);
3. of the proven cutoffs, the one that rejects most bad holdouts less good ones is
   used, the loosest of equals; none if that is not above 0. Any choice among
   proven cutoffs keeps the guarantee, and a stratum with too few labels to prove
   anything has no learned rule.

Everything is DataFrame functions. Statistics come from one pass over the
texts without a shuffle: three-word windows of a text are sorted in the row by
(hash, words, place), equal neighbours mark the places that repeat. They are written
once (whole numbers only) and joined with the labels by id. Tests and cutoffs
are aggregates of one row per stratum, rule and cutoff.

Defined cases: a null or empty text has no words and fails the base rule;
holdouts are labelled documents that pass the base rule, one per id (the least statistics
if an id has several rows; the largest label if several); a null label or id is
no holdout; without labels only the base rule holds; repeated rows are judged
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import SPACE_CHARS, prepare
from moodstream.plans.scalar import attach_row

WORD, SYMBOLS = r"[^\x20\x09-\x0D]+", "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
# Each learned rule: its statistic (a whole number) and its ladder of cutoffs, loosest first. A text above the cutoff fails.
RULES = {
    "long_words": ("100 * word_chars div greatest(n_words, 1)", (1500, 1200, 1000, 900, 800, 750, 700, 650, 600, 550)),
    "short_words": ("- (100 * word_chars div greatest(n_words, 1))", (-200, -250, -300, -350, -400, -450)),
    "symbols": ("1000 * n_symbols div greatest(n_words, 1)", (2000, 1000, 500, 300, 200, 100, 50, 20, 10)),
    "repeated_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", (900, 700, 500, 400, 300, 200, 100)),
    "repeated_words": ("100 * n_repeat_words div greatest(n_words, 1)", (45, 40, 35, 30, 25, 20, 15, 10, 5)),
}
BANDS = "CASE WHEN n_words < 150 THEN 'short' WHEN n_words < 500 THEN 'medium' ELSE 'long' END"


def _with(value: Column, use) -> Column:
    """``use(value)``, where ``value`` is computed once."""
    return F.transform(F.array(value), use)[0]


def _n_repeated(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more."""

    def places(sorted_: Column) -> Column:
        after = F.slice(sorted_, 2, F.size(sorted_))
        same = F.zip_with(sorted_, after, lambda a, b: F.when((a["h"] == b["h"]) & (a["s"] == b["s"]), F.array(a["at"], b["at"])))
        return F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda p: p.isNotNull()))))

    def covered(at: Column) -> Column:
        # Each place covers its word and the next two, up to the next place.
        steps = F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, v: s + v)

    def windows(w: Column) -> Column:
        triples = F.zip_with(F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.slice(w, 3, F.size(w)),
                             lambda p, c: F.when(c.isNotNull(), F.concat_ws(" ", p["a"], p["b"], c)))
        listed = F.transform(triples, lambda t, k: F.struct(F.xxhash64(t).alias("h"), t.alias("s"), k.cast("long").alias("at")))
        return F.sort_array(F.filter(listed, lambda t: t["s"].isNotNull()))

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def told(w: Column) -> Column:
        # Most texts repeat nothing, which their windows' hashes show at once.
        apart = F.size(F.array_distinct(hashes(w))) == F.size(w) - 2
        nothing = F.lit(0).cast("long")
        return F.when(F.size(w) < 3, nothing).when(apart, nothing).otherwise(_with(windows(w), lambda s: _with(places(s), covered)))

    return _with(words, told)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """_id, n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words, and ``keep``."""
    text = docs.select(F.col(id_col).alias("_id"), *(keep or []), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rest = [F.col(c) for c in text.columns if c != "_text"]
    words = F.regexp_extract_all("_text", F.lit(WORD), 0)
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    counted = F.transform(F.array(lines), lambda x: F.struct(F.size(x).cast("long").alias("all"), F.size(F.array_distinct(x)).cast("long").alias("own")))[0]
    made = text.select(
        *rest,
        F.length(F.translate("_text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        counted.alias("_lines"),
        _with(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _n_repeated(w).alias("repeated"))).alias("_words"),
    )
    return made.select(*rest, F.col("_words.n").alias("n_words"), "word_chars", "n_symbols", F.col("_lines.all").alias("n_lines"),
                       (F.col("_lines.all") - F.col("_lines.own")).alias("n_dup_lines"), F.col("_words.repeated").alias("n_repeat_words"))


def _base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words")


def _allowed(n: Column, rate: float, error: Column) -> Column:
    """The largest k with P(Bin(n, rate) <= k) <= error; -1 if there is none.
    Below the mean the tail grows by one term a step."""
    start = F.struct((n * F.log1p(F.lit(-rate))).alias("log"), F.lit(0.0).alias("tail"), F.lit(-1).cast("long").alias("k"))

    def step(s: Column, k: Column) -> Column:
        tail = s["tail"] + F.exp(s["log"])
        onward = s["log"] + F.log((n - k).cast("double")) - F.log((k + 1).cast("double")) + F.log(F.lit(rate)) - F.log1p(F.lit(-rate))
        return F.struct(F.coalesce(onward, s["log"]).alias("log"), tail.alias("tail"), F.when(tail <= error, k).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * rate)), start, step)["k"]


def certified(holdouts: DataFrame, risk: float, error: float, rules: dict = RULES) -> DataFrame:
    """stratum, rule, cutoff from holdouts (stratum, good, and the statistics)."""
    rate = risk / len(rules)
    values = F.array(*[F.struct(F.lit(name).alias("rule"), F.expr(stat).cast("long").alias("value"), F.lit(list(ladder)).alias("ladder"))
                       for name, (stat, ladder) in rules.items()])
    each = holdouts.select("stratum", "good", F.explode(values).alias("r")).select("stratum", "good", "r.rule", "r.value", F.posexplode("r.ladder").alias("step", "cutoff"))
    failed = F.col("value") > F.col("cutoff")
    tests = each.groupBy("stratum", "rule", "step", "cutoff").agg(
        F.count_if("good").alias("n"), F.count_if(F.col("good") & failed).alias("lost"), F.count_if(~F.col("good") & failed).alias("caught"))
    # One row per stratum from here on: ladders are short lists.
    ladders = tests.groupBy("stratum", "rule").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("step", "cutoff", "lost", "caught"))).alias("ladder"))
    ladders = attach_row(ladders, holdouts.agg(F.countDistinct("stratum").alias("strata")))
    allowed = _allowed(F.col("n"), rate, F.lit(error) / (F.col("strata") * len(rules)))
    ladders = ladders.withColumn("allowed", allowed)
    proven = F.filter("ladder", lambda t, k: F.forall(F.slice("ladder", 1, k + 1), lambda u: u["lost"] <= F.col("allowed")))
    ranked = F.transform(proven, lambda t: F.struct((t["caught"] - t["lost"]).alias("gain"), (-t["step"]).alias("loose"), t["cutoff"].alias("cutoff")))
    best = F.array_max(ranked)
    return ladders.select("stratum", "rule", best.alias("b")).where("b.gain > 0").select("stratum", "rule", F.col("b.cutoff").cast("long").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: Column | None = None, risk: float = 0.05, error: float = 0.05, rules: dict = RULES,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines, stratum, failed_rules. ``stratum``: a column of
    ``docs``; ``risk``: the most of a stratum's good documents that the
    learned rules may reject; ``error``: the chance that any of that is untrue."""
    prepare(docs.sparkSession)
    given = [] if stratum is None else [stratum.cast("string").alias("stratum")]
    found = statistics(docs, id_col, text_col, given)
    band = F.expr(BANDS) if stratum is None else F.coalesce("stratum", F.lit("(none)"))
    # Written out: read for the holdouts and for the result.
    found = found.withColumn("stratum", band).withColumn("base_failed", _base_failed()).checkpoint()

    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) == 1).alias("good"))
    numbers = ["stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    passed = found.where(~F.col("base_failed") & F.col("_id").isNotNull()).groupBy("_id").agg(F.min(F.struct(*numbers)).alias("s"))
    cutoffs = certified(passed.join(known, "_id").select("good", "s.*"), risk, error, rules)
    table = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")).checkpoint()
    small = table.count() <= 10_000
    judged = found.join(F.broadcast(table) if small else table, "stratum", "left")
    broken = F.array_compact(F.array(*[F.when(F.expr(stat) > F.try_element_at("cutoffs", F.lit(name)), F.lit(name)) for name, (stat, _) in rules.items()]))
    failed = F.when(F.col("base_failed") | F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(broken)
    return judged.withColumn("failed_rules", failed).select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "n_lines", "stratum", "failed_rules")
