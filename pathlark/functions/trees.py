"""Tree ensembles as column expressions: scoring stays inside the generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.functions.numeric import clamp_probability


@dataclass(frozen=True)
class Split:
    """Go ``left`` when feature <= threshold, else ``right``; a float is a leaf."""

    feature: str
    threshold: float
    left: "Split | float"
    right: "Split | float"


@dataclass(frozen=True)
class Ensemble:
    """P = 1 / (1 + exp(-link · (rate · Σ trees + intercept)))."""

    trees: tuple
    rate: float = 0.1
    intercept: float = 0.0
    link: float = 1.0
    weights: tuple[float, ...] | None = None


# Hand-set starting model, used until one has been trained: more interaction, a cart or favourite,
# a buying user and a matching category each raise the score.
STARTER = Ensemble(
    trees=(
        Split("pv_count_5min", 1.5,
              Split("is_cart_or_fav", 0.5, -4.0, 2.5),
              Split("buy_rate", 0.25, 1.0, 6.0)),
        Split("buy_rate", 0.75,
              Split("active_score", 0.5, -2.0, 0.5),
              Split("category_match", 0.5, 3.0, 5.5)),
        Split("category_match", 0.5,
              Split("pv_count_5min", 2.5, -1.0, 0.75),
              Split("buy_rate", 1.25, 2.25, 4.0)),
        Split("active_score", 0.25,
              Split("buy_rate", 0.05, -3.0, -1.5),
              Split("pv_count_5min", 3.5, 0.25, Split("is_cart_or_fav", 0.5, 1.25, 3.5))),
        Split("is_cart_or_fav", 0.5,
              Split("buy_rate", 1.0, -0.75, 1.5),
              Split("active_score", 0.75, 0.5, 2.75)),
    ),
    rate=0.125,
    intercept=-1.0,
)


def _tree(node: Split | float, x: dict[str, Column]) -> Column:
    if not isinstance(node, Split):
        return F.lit(float(node))
    return F.when(x[node.feature] <= F.lit(node.threshold), _tree(node.left, x)).otherwise(
        _tree(node.right, x)
    )


def margin(model: Ensemble, x: dict[str, Column]) -> Column:
    weights = model.weights or (1.0,) * len(model.trees)
    parts = [
        _tree(t, x) if w == 1.0 else _tree(t, x) * F.lit(w) for t, w in zip(model.trees, weights)
    ]
    return reduce(lambda a, b: a + b, parts) * F.lit(model.rate) + F.lit(model.intercept)


#: Splits up to which the trees are nested conditions. Beyond, code would outgrow what Java compiles in one
#: method, and trees are scored by bit vectors.
NESTED_SPLITS = 100
#: Leaves of a tree that fit in a bit vector; an ensemble with a larger tree is walked, node by node.
VECTOR_LEAVES = 64


def splits(node: Split | float) -> int:
    return 1 + splits(node.left) + splits(node.right) if isinstance(node, Split) else 0


def uncompiled(value: Column) -> Column:
    """The same value, evaluated by walking the expression: of a tree only the nodes on a row's path."""
    return F.get(F.transform(F.array(F.lit(0)), lambda _: value), F.lit(0))


def leaf_values(node: Split | float) -> list[float]:
    """Leaves from left to right."""
    return leaf_values(node.left) + leaf_values(node.right) if isinstance(node, Split) else [float(node)]


def _ruled_out(node: Split | float, first: int, out: dict[str, list[tuple[float, int]]]) -> int:
    """Per feature (threshold, leaves that a value above it rules out); returns the number of leaves."""
    if not isinstance(node, Split):
        return 1
    left = _ruled_out(node.left, first, out)
    out.setdefault(node.feature, []).append((node.threshold, ((1 << left) - 1) << first))
    return left + _ruled_out(node.right, first + left, out)


def _table(values: Sequence[object], kind: str) -> Column:
    """An array literal; as one text it costs one call, however long it is."""
    return F.expr(f"cast(split('{','.join(map(str, values))}', ',') as array<{kind}>)")


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def margin_by_vectors(rows: DataFrame, model: Ensemble, x: dict[str, str], out: str) -> DataFrame:
    """Add the margin, by bit vectors of leaves instead of walking the trees.

    The thresholds of a feature, over all trees, are sorted; a value's rank among them is found by a binary
    search in steps. Every rank stands for a mask of the leaves that splits below the value rule out. The masks
    of all features together leave a few leaves of each tree, of which the leftmost is the exit. Small trees
    share a word: with 8 leaves at most, 8 trees to a word, whose byte is looked up in a table of values.

    Everything is a primitive column expression on arrays that are literals. Words and sums of some trees are used
    twice each, which makes Spark evaluate them once, in methods of their own, small enough to be compiled.
    """
    weights = model.weights or (1.0,) * len(model.trees)
    leaves = [[v * w for v in leaf_values(t)] for t, w in zip(model.trees, weights)]
    lane = 8 if max(map(len, leaves)) <= 8 else 16 if max(map(len, leaves)) <= 16 else 32 if max(map(len, leaves)) <= 32 else 64
    per_word = 64 // lane
    ruled: list[dict[str, list[tuple[float, int]]]] = []
    for t in model.trees:
        ruled.append({})
        _ruled_out(t, 0, ruled[-1])
    thresholds = {f: sorted({v for own in ruled for v, _ in own.get(f, [])}) for f in x}
    used = {f: v for f, v in thresholds.items() if v}

    steps = {f: len(v).bit_length() for f, v in used.items()}
    sorted_of = {f: _table([*map(repr, v), *["Infinity"] * ((1 << steps[f]) - 1 - len(v))], "double") for f, v in used.items()}
    ranked = rows.select("*", *(F.lit(0).alias(f"_r_{f}") for f in used))
    for k in range(max(steps.values(), default=0)):
        moved = {}
        for f in used:
            if k < steps[f]:
                step, r = 1 << (steps[f] - 1 - k), F.col(f"_r_{f}")
                moved[f"_r_{f}"] = r + F.when(F.get(sorted_of[f], r + F.lit(step - 1)) < F.col(x[f]), F.lit(step)).otherwise(F.lit(0))
        ranked = ranked.withColumns(moved)

    total: list[Column] = []
    for first in range(0, len(leaves), per_word):
        own = range(first, min(first + per_word, len(leaves)))
        parts = []
        for f, values in used.items():
            masks, word = [], (1 << 64) - 1
            out_at: dict[float, int] = {}
            for i in own:
                for v, m in ruled[i].get(f, []):
                    out_at[v] = out_at.get(v, 0) | m << lane * (i - first)
            if not out_at:
                continue
            for v in [None, *values]:
                word &= ~out_at.get(v, 0)
                masks.append(_signed(word))
            masks += masks[-1:] * ((1 << steps[f]) - len(masks))
            parts.append(F.get(_table(masks, "bigint"), F.col(f"_r_{f}")))
        word = reduce(lambda a, b: a.bitwiseAND(b), parts) if parts else F.lit(-1).cast("bigint")
        found = []
        for i in own:
            left = F.shiftrightunsigned(word, lane * (i - first)) if per_word > 1 else word
            left = left.bitwiseAND(F.lit((1 << lane) - 1)) if per_word > 1 else left
            if lane == 8:
                values = [leaves[i][min((b & -b).bit_length() - 1, len(leaves[i]) - 1)] if b else 0.0 for b in range(256)]
                found.append(F.get(_table(map(repr, values), "double"), left.cast("int")))
            else:
                lowest = F.bit_count(left.bitwiseAND(-left) - F.lit(1).cast("bigint"))
                found.append(F.get(_table(map(repr, leaves[i]), "double"), lowest))
        total += [reduce(lambda a, b: a + b, found[k : k + 8]) for k in range(0, len(found), 8)]
    half = F.lit(0.5)  # twice a half is exactly the sum
    z = reduce(lambda a, b: a + b, [t * half + t * half for t in total]) * F.lit(model.rate) + F.lit(model.intercept)
    return ranked.select(*rows.columns, z.alias(out))


def score_tree_ensemble(
    rows: DataFrame,
    model: Ensemble = STARTER,
    out: str = "predict_score",
    features: Sequence[str] = S.MODEL_FEATURES,
    float32: bool = True,
) -> DataFrame:
    """Add P(buy). Inputs are rounded to float32 first, a missing one counts as 0.

    Rounded inputs and the margin are projections of their own, so each is computed once per row
    and the comparisons work on plain attributes. Large ensembles are scored by bit vectors.
    """
    def rounded(name: str) -> Column:
        value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        return value.cast("float").cast("double") if float32 else value

    ready = rows.select("*", *[rounded(c).alias(f"_x_{c}") for c in features])
    if sum(map(splits, model.trees)) <= NESTED_SPLITS:
        scored = ready.withColumn("_z", margin(model, {c: F.col(f"_x_{c}") for c in features}))
    elif max(len(leaf_values(t)) for t in model.trees) <= VECTOR_LEAVES:
        scored = margin_by_vectors(ready, model, {c: f"_x_{c}" for c in features}, "_z")
    else:
        scored = ready.withColumn("_z", uncompiled(margin(model, {c: F.col(f"_x_{c}") for c in features})))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("_z") * F.lit(-model.link)))
    return scored.select(*rows.columns, clamp_probability(p).alias(out))


def ensemble_from_nodes(nodes: DataFrame, weights: Sequence[float], features: Sequence[str],
                        link: float = 2.0) -> Ensemble:
    """Build an ensemble from the node table a saved Spark boosted-tree model consists of.

    The table has one row per tree node: its size is fixed by the model, not by any data.
    """
    table: dict[tuple[int, int], object] = {}
    for row in nodes.select("treeID", "nodeData.*").collect():
        table[(row["treeID"], row["id"])] = row

    def build(tree: int, node: int) -> Split | float:
        row = table[(tree, node)]
        if row["leftChild"] < 0:
            return float(row["prediction"])
        split = row["split"]
        return Split(
            features[split["featureIndex"]], float(split["leftCategoriesOrThreshold"][0]),
            build(tree, row["leftChild"]), build(tree, row["rightChild"]),
        )

    trees = tuple(build(t, 0) for t in range(len(weights)))
    return Ensemble(trees, rate=1.0, intercept=0.0, link=link, weights=tuple(weights))
