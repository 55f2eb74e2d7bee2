"""A hierarchy of stacked classifiers: one stack for each inner node, met on the way down."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.graph import written


@dataclass
class Stack:
    """A node's base models and the one above them; a node with one label has none."""

    labels: list[str]
    bases: list[PipelineModel] = field(default_factory=list)
    top: PipelineModel | None = None


def bases(trees: int, depth: int) -> list[Pipeline]:
    """A forest, and straight margins one label against the rest, both on scaled features."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    forest = RandomForestClassifier(featuresCol="scaled", labelCol="label", probabilityCol="probability", rawPredictionCol="rawPrediction", numTrees=trees, maxDepth=depth, seed=42)
    margins = OneVsRest(featuresCol="scaled", labelCol="label", weightCol="weight", classifier=LinearSVC(maxIter=30), parallelism=2)
    return [Pipeline(stages=[scaler, forest]), Pipeline(stages=[scaler, margins])]


def with_scores(models: list[PipelineModel], rows: DataFrame) -> DataFrame:
    """rows with `blend`: the features and what each base model says of each label."""
    spare = ["scaled", "rawPrediction", "probability", "prediction"]
    for k, model in enumerate(models):
        out = model.transform(rows)
        score = "probability" if "probability" in out.columns else "rawPrediction"
        rows = out.withColumn(f"__s{k}", F.col(score)).drop(*spare)
    parts = [f"__s{k}" for k in range(len(models))]
    return VectorAssembler(inputCols=["features", *parts], outputCol="blend").transform(rows).drop(*parts)


def fit_node(rows: DataFrame, key: str, folds: int, trees: int, depth: int) -> Stack:
    """The stack of rows (key, features, class): what the top model learns from is said by models of the other folds.

    A fold is a hash of the key. Labels are weighed against their frequency. A fold that lacks a label leaves its
    score low.
    """
    counts = {r["class"]: r["count"] for r in rows.groupBy("class").count().collect()}
    labels = sorted(counts)
    if len(labels) < 2:
        return Stack(labels)
    of = lambda values: F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[F.col("class")]
    total = sum(counts.values())
    rows = written(
        rows.withColumns({"weight": of({c: total / (len(labels) * n) for c, n in counts.items()}), "fold": F.pmod(F.xxhash64(key), F.lit(folds))}), "node"
    )
    rows = StringIndexer(inputCol="class", outputCol="label", stringOrderType="alphabetAsc").fit(rows).transform(rows)
    blended = None
    for f in range(folds):
        models = [p.fit(rows.filter(F.col("fold") != f)) for p in bases(trees, depth)]
        part = with_scores(models, rows.filter(F.col("fold") == f))
        blended = part if blended is None else blended.unionByName(part)
    top = Pipeline(stages=[StandardScaler(inputCol="blend", outputCol="ready", withMean=True), LogisticRegression(featuresCol="ready", labelCol="label", weightCol="weight", family="multinomial", probabilityCol="chance", rawPredictionCol="margin", regParam=0.01)])
    return Stack(labels, [p.fit(rows) for p in bases(trees, depth)], top.fit(written(blended.select("blend", "label", "weight"), "blend")))


def fit(rows: DataFrame, key: str, path: str, folds: int = 3, trees: int = 40, depth: int = 8) -> dict[str, Stack]:
    """Stacks by inner node of rows (key, features, path): a path is an array of codes from the root, '' the root's name."""
    inner = rows.select(key, "features", F.posexplode(path).alias("__d", "class"), F.col(path).alias("__p"))
    inner = written(inner.withColumn("node", F.array_join(F.slice("__p", F.lit(1), F.col("__d")), ".")), "nodes")
    names = [r.node for r in inner.select("node").distinct().collect()]
    return {node: fit_node(inner.filter(F.col("node") == node).select(key, "features", "class"), key, folds, trees, depth) for node in sorted(names)}


def node_chances(stack: Stack, rows: DataFrame) -> DataFrame:
    """rows with `__chances`, an array of struct(chance, code) of the node's children."""
    if stack.top is None:
        return rows.withColumn("__chances", F.array(F.struct(F.lit(1.0).alias("chance"), F.lit(stack.labels[0]).alias("code"))))
    out = stack.top.transform(with_scores(stack.bases, rows))
    chance = vector_to_array("chance")
    out = out.withColumn("__chances", F.array(*(F.struct(chance[k].alias("chance"), F.lit(code).alias("code")) for k, code in enumerate(stack.labels))))
    return out.drop("blend", "ready", "margin", "chance", "prediction")


def classified(stacks: dict[str, Stack], rows: DataFrame, key: str) -> DataFrame:
    """(key, path, score): the path of the highest mean chance of its nodes, among all from the root to a leaf.

    Every inner node gives its children's chances to every row; ties go to the greater code.
    """
    rows = rows.select(key, "features")
    per_node = [node_chances(stack, rows).select(key, F.lit(node).alias("node"), F.explode("__chances").alias("c")).select(key, "node", "c.*") for node, stack in stacks.items()]
    chances = per_node[0]
    for more in per_node[1:]:
        chances = chances.unionByName(more)
    by_code = chances.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(">", "node", "code"), "chance"))).alias("m"))

    def paths(node: str) -> list[list[tuple[str, str]]]:
        found = []
        for code in stacks[node].labels:
            below = f"{node}.{code}" if node else code
            found += [[(node, code), *rest] for rest in paths(below)] if below in stacks else [[(node, code)]]
        return found

    options = [F.struct((sum((F.col("m")[f"{n}>{c}"] for n, c in p), F.lit(0.0)) / len(p)).alias("score"), F.lit(".".join(c for _, c in p)).alias("path")) for p in paths("")]
    return by_code.select(key, F.array_max(F.array(*options)).alias("b")).select(key, "b.path", "b.score")
