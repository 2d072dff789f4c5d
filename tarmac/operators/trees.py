"""A fitted decision tree as a table of nodes, and its predictions as SQL text."""

from tarmac.constants import FEATURE_ORDER
from tarmac.sources.stage import new_stage_path

NODES = (
    "node long, depth int, feature string, bound double, categories string, gain double, "
    "on_time double, late double, prediction double"
)


def tree_nodes(spark, model, features=FEATURE_ORDER):
    """One row for each node; the children of node i are nodes 2i, to the left, and 2i + 1.

    A row goes left if its ``feature`` is at most ``bound`` or one of the ``categories``. Leaves
    have no feature. ``on_time`` and ``late`` are the training rows that a node has seen. The
    depth limit bounds the table, so the driver may number the nodes.
    """
    path = new_stage_path(spark, "tree")
    model.write().overwrite().save(path)
    saved = {r["id"]: r for r in spark.read.parquet(f"{path}/data").collect()}
    rows, open_nodes = [], [(0, 1, 0)]
    while open_nodes:
        number, node, depth = open_nodes.pop()
        row = saved[number]
        seen = [float(n) for n in row["impurityStats"]]
        if row["leftChild"] < 0:
            rows.append((node, depth, None, None, None, None, *seen, row["prediction"]))
            continue
        open_nodes.append((row["leftChild"], 2 * node, depth + 1))
        open_nodes.append((row["rightChild"], 2 * node + 1, depth + 1))
        split = row["split"]
        values = split["leftCategoriesOrThreshold"]
        bound, categories = values[0], None
        if split["numCategories"] >= 0:
            bound, categories = None, ",".join(str(int(v)) for v in sorted(values))
        feature = features[split["featureIndex"]]
        rows.append((node, depth, feature, bound, categories, row["gain"], *seen, row["prediction"]))
    return spark.createDataFrame(rows, NODES)


def prediction_sql(nodes):
    """The predictions as one SQL expression over the feature columns."""
    rows = {r["node"]: r for r in nodes.collect()}

    def text(node):
        row = rows[node]
        if row["feature"] is None:
            return f"{row['prediction']:.1f}"
        if row["categories"] is None:
            left = f"{row['feature']} <= {row['bound']!r}"
        else:
            left = f"{row['feature']} IN ({row['categories']})"
        return f"CASE WHEN {left} THEN {text(2 * node)} ELSE {text(2 * node + 1)} END"

    return text(1)
