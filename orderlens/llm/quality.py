"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of the whole text are Column expressions (``STATISTICS``), computed in the JVM.
2. A forest of shallow trees is grown on labelled rows.  Every path from a root to a node is a
   conjunctive rule: bounds on some statistics.
3. A lasso logistic regression on the 0/1 rules leaves few of them with a weight.
4. Those are compiled to one Column: the logistic function of the weighted rules.  Scoring reads each
   text once, without a model object on the executors.

Fitting uses at most about ``MAX_LABELLED`` labelled rows, chosen by a hash of the id (a bound of
the method; scoring covers all rows).  They are laid in id order in one partition, so that a rerun
grows the same trees.  Labels, language, source and id are no statistics.

Cases: null and empty texts have all statistics 0 and get the score of those; a label table that is empty or has one
class gives the constant score of its share (0.5 if empty); conflicting labels of one id count by
their mean; rows without an id are scored and never trained on; repeated rows are scored alike; very long
texts are read whole; an empty table gives an empty result; other columns of a like name are kept as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import fresh, hash_fraction, stored, word_count, workspace

MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 24, 3, 7
LASSO = 0.002
HELD_OUT_FOLDS, HELD_OUT_FOLD = 3, 1

# ---- fixed values: character classes of the statistics ----
UPPER, DIGIT, STOP, SYMBOL = r"\p{Lu}", "[0-9]", "[.,;:?]", r"""[^\p{L}\p{M}\p{N}\s.,;:?'"()\-]"""


def _share(count: Column, of: Column) -> Column:
    return F.when(of > 0, count / of).otherwise(F.lit(0.0))


def _distinct_share(text: Column, separator: str) -> Column:
    parts = F.split(text, separator)
    return F.size(F.array_distinct(parts)) / F.size(parts)


def statistics(text: Column) -> dict[str, Column]:
    """Name -> expression; ``text`` must not be null."""
    n = F.length(text)
    words = word_count(text)
    return {
        "log_words": F.log1p(words.cast("double")),
        "word_length": _share(n.cast("double"), words),
        "upper": _share(F.regexp_count(text, F.lit(UPPER)), n),
        "digits": _share(F.regexp_count(text, F.lit(DIGIT)), n),
        "stops": _share(F.regexp_count(text, F.lit(STOP)), n),
        "symbols": _share(F.regexp_count(text, F.lit(SYMBOL)), n),
        "distinct_words": F.when(n > 0, _distinct_share(text, "[ \n]")).otherwise(F.lit(0.0)),
        "distinct_lines": F.when(n > 0, _distinct_share(text, "\n")).otherwise(F.lit(0.0)),
    }


STATISTICS = ("log_words", "word_length", "upper", "digits", "stops", "symbols", "distinct_words", "distinct_lines")


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics: name -> (above, at most), either may be None."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def column(self, names: dict[str, str]) -> Column:
        holds = F.lit(True)
        for name, above, most in self.bounds:
            if above is not None:
                holds = holds & (F.col(names[name]) > above)
            if most is not None:
                holds = holds & (F.col(names[name]) <= most)
        return holds.cast("double")


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules and the intercept."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, names: dict[str, str]) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + rule.column(names) * weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(description: str) -> list[Rule]:
    """The paths of a printed decision tree: a rule for every node below the root."""
    path: list[tuple[int, str, str, float]] = []
    found = []
    for line in description.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        indent = len(m[1])
        path = [p for p in path if p[0] < indent]
        path.append((indent, STATISTICS[int(m[2])], m[3], float(m[4])))
        bounds: dict[str, tuple[float | None, float | None]] = {}
        for _, name, sign, value in path:
            above, most = bounds.get(name, (None, None))
            if sign == ">":
                above = value if above is None else max(above, value)
            else:
                most = value if most is None else min(most, value)
            bounds[name] = (above, most)
        found.append(Rule(tuple((k, *v) for k, v in sorted(bounds.items()))))
    return found


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HELD_OUT_FOLDS)) == HELD_OUT_FOLD, F.lit(False))


def labelled_statistics(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, the statistics, label) of the training rows."""
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    marks = stored(marks, "quality-labels")
    share = max_labelled / max(1, marks.count())
    if share < 1:
        marks = marks.where(hash_fraction(F.lit("fit"), F.col("doc_id")) < share)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # the sample's size is bounded by max_labelled, whatever the size of the corpus
    rows = rows.join(F.broadcast(marks), "doc_id")
    return stored(rows.select("doc_id", *[c.alias(k) for k, c in statistics(F.col("text")).items()], "label"), "quality-statistics")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> RuleModel:
    """Grow the forest, take its rules, and fit their weights."""
    with workspace(docs.sparkSession):
        return _fit(labelled_statistics(docs, labels, max_labelled))


def _fit(rows: DataFrame) -> RuleModel:
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    n, share = rows.agg(F.count(F.lit(1)), F.avg("label")).first()
    if not n or share in (0.0, 1.0):
        share = 0.5 if not n else share
        # the constant score of the share, kept inside (0, 1)
        from math import log

        p = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel(log(p / (1 - p)), ())
    # a bounded number of rows, in a fixed order: the same forest every time
    rows = rows.coalesce(1).sortWithinPartitions("doc_id", *STATISTICS)
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows).select("features", "label", *STATISTICS)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64, minInstancesPerNode=max(1, n // 1000), subsamplingRate=0.7, featureSubsetStrategy="0.5"
    ).fit(assembled)
    rules = list(dict.fromkeys(r for t in forest.trees for r in tree_rules(t.toDebugString)))
    names = {s: s for s in STATISTICS}
    matrix = rows.select("label", *[r.column(names).alias(f"r{i}") for i, r in enumerate(rules)])
    vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(matrix).select("features", "label")
    # fitting reads these rows in every iteration; they are few
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(vectors)
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights) if w))


def _measured(docs: DataFrame, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the statistics of its text, and the names of their columns."""
    text, *named = fresh(docs, "_q_text", *[f"_q_{s}" for s in STATISTICS])
    names = dict(zip(STATISTICS, named))
    rows = docs.select("*", F.coalesce(F.col(text_col), F.lit("")).alias(text))
    return rows.select("*", *[c.alias(names[k]) for k, c in statistics(F.col(text)).items()]), names


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of its text."""
    measured, names = _measured(docs, text_col)
    return measured.select(*[measured[c] for c in docs.columns if c.lower() != score_col.lower()], model.score(names).alias(score_col))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    rows = docs.select("doc_id", "text")
    return score(rows, fit(rows, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    model = fit(docs.select("doc_id", "text"), labels)
    measured, names = _measured(docs, "text")
    # Catalyst would put a filter on the score below the statistics, with all of them in it again for each
    # rule; it leaves a projection that isn't deterministic where it is
    (fence,) = fresh(measured, "_q_fence")
    fenced = measured.withColumn(fence, F.monotonically_increasing_id())
    return fenced.where((model.score(names) >= 0.5) & (F.col(fence) >= 0)).select(*[F.col(f"`{c}`") for c in docs.columns])
