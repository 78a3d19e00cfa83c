"""Detections: post-processing, suppression, matching, evaluation, losses, mining.

Predictions: (image_id, det_no, class_id, cx, cy, w, h, score[, class_scores]).
Annotations: (image_id, ann_no, class_id, cx, cy, w, h). Images: (image_id, width, height).
Boxes are normalized centre boxes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.boxes import argmax, corner, intersection, iou, pixel_corner, ratio
from sparquill.plans.scale import prefix_sums, top_k
from sparquill.session import cut

CROWD = 2000  # boxes per image above which the image is cut into a grid
BLOCKS = 1024  # most blocks a crowd is cut into
SMALL_TABLE = 100_000  # rows a table may have to be broadcast (a few MB here)


def postprocess(raw: DataFrame, score_threshold: float = 0.5) -> DataFrame:
    """Class with the best score, kept if that score is strictly above the threshold.

    Scaling to the original size and back to 0..1 leaves the box as it is.
    """
    scored = raw.withColumns({"class_id": argmax(F.col("class_scores")), "score": F.array_max("class_scores")})
    return scored.filter(F.col("score") > score_threshold)


# ---- pairs of boxes -------------------------------------------------------------------------


def _crowds(a: DataFrame, b: DataFrame, limit: int) -> DataFrame | None:
    """Extent, grid and block count of the images with many boxes; None when there are none.

    A cell is at least twice as large as the mean box, so a box gets few copies. Where large
    boxes leave too few cells, one side is cut into blocks and the other repeated per block.
    """
    def edges(df: DataFrame, p: str) -> DataFrame:
        x, y, w, h = (F.col(f"{p}_{c}").cast("double") for c in "xywh")
        return df.select("image_id", x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + h).alias("y1"))

    both = edges(a, "a").unionAll(edges(b, "b"))
    big = (
        both.groupBy("image_id")
        .agg(
            F.count("*").alias("n"),
            F.min("x0").alias("x0"), F.min("y0").alias("y0"),
            F.max("x1").alias("x1"), F.max("y1").alias("y1"),
            F.avg(F.col("x1") - F.col("x0")).alias("mw"), F.avg(F.col("y1") - F.col("y0")).alias("mh"),
        )
        .filter(F.col("n") > limit)
    )
    most = F.ceil(F.sqrt(F.col("n") / F.lit(limit)))

    def cells(size: str, mean: str) -> Column:
        return F.greatest(F.lit(1), F.least(most, F.floor(F.col(size) / (2 * F.col(mean) + F.lit(1e-12))))).cast("int")

    sized = big.withColumns(
        {
            "sx": F.greatest(F.col("x1") - F.col("x0"), F.lit(1e-12)),
            "sy": F.greatest(F.col("y1") - F.col("y0"), F.lit(1e-12)),
        }
    ).withColumns({"gx": cells("sx", "mw"), "gy": cells("sy", "mh")})
    blocks = F.ceil(4 * F.col("n") / (F.lit(limit) * F.col("gx") * F.col("gy")))
    found = sized.select(
        "image_id", "x0", "y0", "sx", "sy", "gx", "gy",
        F.greatest(F.lit(1), F.least(blocks, F.lit(BLOCKS))).cast("int").alias("blocks"),
    )
    n = found.limit(SMALL_TABLE + 1).count()
    if n == 0:
        return None
    return F.broadcast(found) if n <= SMALL_TABLE else found


_GRID = ["x0", "y0", "sx", "sy", "gx", "gy", "blocks"]


def _slot(v: Column, axis: str) -> Column:
    grid = F.col(f"g{axis}")
    at = F.floor((v - F.col(f"{axis}0")) / F.col(f"s{axis}") * grid).cast("int")
    return F.greatest(F.lit(0), F.least(at, grid - 1))


def _gridded(df: DataFrame, p: str, crowds: DataFrame) -> DataFrame:
    """Boxes of crowds once per cell they touch; side b also once per block, side a in one block."""
    x, y, w, h = (F.col(f"{p}_{c}") for c in "xywh")
    placed = df.join(crowds, "image_id", "left")
    xs, ys = F.sequence(_slot(x, "x"), _slot(x + w, "x")), F.sequence(_slot(y, "y"), _slot(y + h, "y"))
    cells = F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: i * F.col("gy") + j)))
    one, calm = F.array(F.lit(0)), F.col("gx").isNull()
    marked = placed.withColumn("_cell", F.explode(F.when(calm, one).otherwise(cells)))
    if p == "a":
        block = F.pmod(F.xxhash64("a_x", "a_y", "a_w", "a_h"), F.col("blocks")).cast("int")
        return marked.withColumn("_block", F.when(calm, F.lit(0)).otherwise(block))
    blocks = F.when(calm, one).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    return marked.withColumn("_block", F.explode(blocks)).select(*df.columns, "_cell", "_block")


def overlapping(a: DataFrame, b: DataFrame, on: Sequence[str] = (), crowd: int = CROWD) -> DataFrame:
    """All pairs of one image that overlap, with ``iou``; pairs without overlap are never built in crowds.

    ``a`` has corner columns a_x, a_y, a_w, a_h, ``b`` the same with b_, both image_id
    (and ``on``). Ordinary images meet in one equi-join on the image. An image with more than
    ``crowd`` boxes is cut into a grid; boxes meet per cell, and a pair counts only in the
    cell of the lowest corner of its intersection.
    """
    return _pairs(a, b, on, _crowds(a, b, crowd))


def _pairs(a: DataFrame, b: DataFrame, on: Sequence[str], crowds: DataFrame | None) -> DataFrame:
    keys = ["image_id", *on]
    ab, bb = [F.col(f"a_{c}") for c in "xywh"], [F.col(f"b_{c}") for c in "xywh"]
    if crowds is None:
        pairs = a.join(b, keys)
    else:
        met = [*keys, "_cell", "_block"]
        # few bytes make many pairs here: a fixed number of partitions keeps adaptive
        # execution from merging them into one task
        n = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = _gridded(a, "a", crowds).repartition(n, *met).join(_gridded(b, "b", crowds), met)
        px, py = F.greatest(ab[0], bb[0]), F.greatest(ab[1], bb[1])
        home = _slot(px, "x") * F.col("gy") + _slot(py, "y")
        pairs = pairs.filter(F.col("gx").isNull() | (F.col("_cell") == home)).drop("_cell", "_block", *_GRID)
    return _met(pairs)


def _met(pairs: DataFrame) -> DataFrame:
    """The pairs that overlap, with ``iou``."""
    ab, bb = [F.col(f"a_{c}") for c in "xywh"], [F.col(f"b_{c}") for c in "xywh"]
    return pairs.filter(intersection(ab, bb) > 0).withColumn("iou", iou(ab, bb))


def _corners(df: DataFrame, p: str, boxes: list[Column], extra: dict[str, Column]) -> DataFrame:
    return df.select("image_id", *[b.alias(f"{p}_{c}") for b, c in zip(boxes, "xywh")], *[v.alias(k) for k, v in extra.items()])


def _center(df_prefix: str = "") -> list[Column]:
    return [F.col(c) for c in ("cx", "cy", "w", "h")]


def pair_iou(pred: DataFrame, truth: DataFrame, images: DataFrame | None = None, min_iou: float = 0.0) -> DataFrame:
    """Overlapping prediction/annotation pairs of each image with IoU above ``min_iou``.

    With ``images`` the boxes are compared in whole pixels, otherwise in 0..1.
    """
    a = _corners(*_boxed(pred, "a", images), {"det_no": F.col("det_no"), "pred_class": F.col("class_id")})
    b = _corners(*_boxed(truth, "b", images), {"ann_no": F.col("ann_no"), "true_class": F.col("class_id")})
    pairs = overlapping(a, b)
    return pairs.filter(F.col("iou") > min_iou).select("image_id", "det_no", "ann_no", "pred_class", "true_class", "iou")


def _boxed(df: DataFrame, p: str, images: DataFrame | None):
    if images is None:
        return df, p, corner(*_center())
    sized = df.join(images.select("image_id", "width", "height"), "image_id")
    return sized, p, pixel_corner(*_center(), F.col("width"), F.col("height"))


# ---- suppression ----------------------------------------------------------------------------


def nms_fold(boxes: Column, threshold: float, corner_of) -> Column:
    """Greedy suppression inside one array of structs that is already in rank order."""
    def step(kept: Column, box: Column) -> Column:
        hit = F.exists(kept, lambda k: iou(corner_of(k), corner_of(box)) > threshold)
        return F.when(hit, kept).otherwise(F.concat(kept, F.array(box)))

    return F.aggregate(boxes, F.slice(boxes, 1, 0), step)


def _reader(compat: bool):
    """How a struct is read as a corner box; ``compat`` takes centre values as corners."""
    def read(s: Column) -> list[Column]:
        box = [s[c] for c in ("cx", "cy", "w", "h")]
        return box if compat else corner(*box)

    return read


def ranked_boxes(boxes: Column) -> Column:
    """Orders an array of structs by score descending, then det_no."""
    return F.array_sort(
        boxes,
        lambda l, r: F.when(l["score"] > r["score"], -1)
        .when(l["score"] < r["score"], 1)
        .when(l["det_no"] < r["det_no"], -1)
        .when(l["det_no"] > r["det_no"], 1)
        .otherwise(0),
    )


def nms(df: DataFrame, threshold: float = 0.4, compat: bool = False, crowd: int = CROWD) -> DataFrame:
    """Class-agnostic greedy suppression per image: a box stays if no better kept box
    overlaps it by more than the threshold. Scores must be positive.

    Images of ordinary size are folded as one array. Images above ``crowd`` boxes are
    solved exactly by rounds over the conflict pairs, spread over the cluster.
    """
    rows = df.filter(F.col("score") > 0)
    big = rows.groupBy("image_id").agg(F.count("*").alias("_n")).filter(F.col("_n") > crowd).select("image_id")
    n = big.limit(SMALL_TABLE + 1).count()
    if n == 0:
        return _nms_small(rows, threshold, compat)
    big = F.broadcast(big) if n <= SMALL_TABLE else big
    small = _nms_small(rows.join(big, "image_id", "left_anti"), threshold, compat)
    return small.unionByName(_nms_crowded(rows.join(big, "image_id", "left_semi"), threshold, compat, crowd))


def _nms_small(rows: DataFrame, threshold: float, compat: bool) -> DataFrame:
    grouped = rows.groupBy("image_id").agg(F.collect_list(F.struct(*rows.columns)).alias("boxes"))
    kept = grouped.select(nms_fold(ranked_boxes(F.col("boxes")), threshold, _reader(compat)).alias("kept"))
    return kept.select(F.inline("kept"))


def _nms_crowded(rows: DataFrame, threshold: float, compat: bool, crowd: int) -> DataFrame:
    """Exact suppression of crowds: rounds over the best boxes while they settle most of the
    rest, then rounds over the conflict pairs of what is left."""
    if threshold >= 1:
        return rows
    box = ["cx", "cy", "w", "h"]
    best = F.min(F.struct((-F.col("score")).alias("neg"), "det_no")).alias("top")
    flat = (F.col("w") * F.col("h")) <= 0
    # equal boxes conflict with the same boxes, so only the best copy can stay
    solid = rows.filter(~flat).groupBy("image_id", *box).agg(best)
    left = cut(solid.select("image_id", *box, F.col("top.neg").alias("neg"), F.col("top.det_no").alias("det_no")))
    settled, n = [], left.count()
    while n:
        chosen, rest = _settle_best(left, threshold, compat, crowd)
        settled.append(chosen)
        before, left = n, rest
        n = left.count()
        if n > before / 2:
            settled.append(_settle_pairs(left, threshold, compat, crowd))
            break
    if not settled:
        return rows.filter(flat)
    kept = settled[0]
    for part in settled[1:]:
        kept = kept.unionAll(part)
    stay = rows.filter(~flat).join(kept, ["image_id", "det_no"], "left_semi")
    return stay.unionByName(rows.filter(flat)).select(*rows.columns)


def _settle_best(left: DataFrame, threshold: float, compat: bool, most: int) -> tuple[DataFrame, DataFrame]:
    """Folds the ``most`` best boxes of every image; returns the kept ones and the boxes
    after them that no kept one suppresses."""
    box = ["cx", "cy", "w", "h"]
    read = _reader(compat)
    head = top_k(left, ["image_id"], [F.col("neg"), F.col("det_no")], most).withColumn("score", -F.col("neg"))
    grouped = head.groupBy("image_id").agg(
        F.collect_list(F.struct("score", "det_no", *box)).alias("b"), F.max(F.struct("neg", "det_no")).alias("last")
    )
    folded = cut(grouped.select("image_id", "last", nms_fold(ranked_boxes(F.col("b")), threshold, read).alias("kept")))
    small = F.broadcast(folded) if folded.count() * most <= SMALL_TABLE else folded
    mine = F.struct(*box)
    hit = F.exists("kept", lambda k: iou(read(k), read(mine)) > threshold)
    later = F.struct("neg", "det_no") > F.col("last")
    rest = left.join(small, "image_id").filter(later & ~hit).select(*left.columns)
    return folded.select("image_id", F.explode("kept.det_no").alias("det_no")), cut(rest)


def _settle_pairs(left: DataFrame, threshold: float, compat: bool, crowd: int) -> DataFrame:
    """Kept boxes by rounds over the conflict pairs: a box that loses to nobody stays, and
    whatever it beats goes."""
    shape = [F.col(c) for c in ("cx", "cy", "w", "h")]
    shape = shape if compat else corner(*shape)
    a = _corners(left, "a", shape, {"win": F.col("det_no"), "win_neg": F.col("neg")})
    b = _corners(left, "b", shape, {"lose": F.col("det_no"), "lose_neg": F.col("neg")})
    first = F.struct(F.col("win_neg"), F.col("win")) < F.struct(F.col("lose_neg").alias("win_neg"), F.col("lose").alias("win"))
    pairs = overlapping(a, b, crowd=crowd)
    edges = cut(pairs.filter((F.col("iou") > threshold) & first).select("image_id", "win", "lose"))
    kept = left.select("image_id", "det_no")
    while not edges.isEmpty():
        losers = edges.select("image_id", F.col("lose").alias("win")).distinct()
        free = edges.join(losers, ["image_id", "win"], "left_anti")
        gone = cut(free.select("image_id", "lose").distinct())
        edges = edges.join(gone, ["image_id", "lose"], "left_anti")
        edges = cut(edges.join(gone.withColumnRenamed("lose", "win"), ["image_id", "win"], "left_anti"))
        kept = cut(kept.join(gone.withColumnRenamed("lose", "det_no"), ["image_id", "det_no"], "left_anti"))
    return kept


# ---- matching and evaluation ----------------------------------------------------------------


def _best_partner(reps: DataFrame, goals: DataFrame, key: list[str], crowds: DataFrame | None) -> DataFrame:
    """Annotation with the highest IoU per prediction box, the lowest ann_no on ties."""
    pairs = _pairs(reps, goals, ["class_id"], crowds)
    if crowds is None:
        order = F.min(F.struct((-F.col("iou")).alias("neg"), "ann_no")).alias("b")
        best = pairs.groupBy(*key).agg(order, F.first("top").alias("top"))
        return best.select(*key, "top", F.col("b.ann_no").alias("ann_no"), (-F.col("b.neg")).alias("best_iou"))
    # many pairs: a plain maximum is kept in a hash table, a struct would sort all pairs;
    # the second pass emits only the pairs that reach the maximum
    peak = cut(pairs.groupBy(*key).agg(F.max("iou").alias("best_iou")))
    tops = _pairs(reps.join(peak, key), goals, ["class_id"], crowds).filter(F.col("iou") == F.col("best_iou"))
    low = tops.groupBy(*key, "best_iou").agg(F.min("ann_no").alias("ann_no"))
    return low.join(reps, key).select(*key, "top", "ann_no", "best_iou")


def match(pred: DataFrame, truth: DataFrame, iou_threshold: float = 0.5, crowd: int = CROWD) -> DataFrame:
    """Every prediction with its best same-class annotation and whether it is a true positive.

    The best annotation ignores earlier claims (highest IoU, then lowest ann_no); the
    best-scored prediction of an annotation claims it, later ones are false positives.
    Equal boxes are compared once.
    """
    box = [c.alias(f"a_{n}") for c, n in zip(corner(*_center()), "xywh")]
    keyed = pred.select("image_id", "class_id", "det_no", "score", *box)
    key = ["image_id", "class_id", "a_x", "a_y", "a_w", "a_h"]
    reps = keyed.groupBy(*key).agg(F.min(F.struct((-F.col("score")).alias("neg"), "det_no")).alias("top"))
    tbox = [c.alias(f"b_{n}") for c, n in zip(corner(*_center()), "xywh")]
    goals = truth.select("image_id", "class_id", "ann_no", *tbox)
    goals = goals.groupBy("image_id", "class_id", "b_x", "b_y", "b_w", "b_h").agg(F.min("ann_no").alias("ann_no"))
    best = _best_partner(reps, goals, key, _crowds(reps, goals, crowd))
    winners = (
        best.filter(F.col("best_iou") >= iou_threshold)
        .groupBy("image_id", "ann_no")
        .agg(F.min("top").alias("top"))
        .select("image_id", F.col("top.det_no").alias("det_no"), F.lit(True).alias("_wins"))
    )
    out = keyed.join(best, key, "left").join(winners, ["image_id", "det_no"], "left")
    return out.select(
        "image_id",
        "det_no",
        "class_id",
        "score",
        F.col("ann_no").alias("best_ann"),
        F.coalesce("best_iou", F.lit(0.0)).alias("best_iou"),
        F.coalesce("_wins", F.lit(False)).alias("tp"),
    )


def image_pr(matches: DataFrame, truth: DataFrame) -> DataFrame:
    """Precision, recall and mean best IoU per image."""
    p = matches.groupBy("image_id").agg(
        F.count_if("tp").alias("tp"), F.count("*").alias("n_pred"), F.avg("best_iou").alias("mean_iou")
    )
    t = truth.groupBy("image_id").agg(F.count("*").alias("n_truth"))
    both = p.join(t, "image_id", "full").fillna(0, ["tp", "n_pred", "n_truth"])
    return both.select(
        "image_id",
        "tp",
        (F.col("n_pred") - F.col("tp")).alias("fp"),
        (F.col("n_truth") - F.col("tp")).alias("fn"),
        ratio(F.col("tp"), F.col("n_pred")).alias("precision"),
        ratio(F.col("tp"), F.col("n_truth")).alias("recall"),
        "mean_iou",
    )


def mean_pr(per_image: DataFrame) -> DataFrame:
    return per_image.agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.count("*").alias("images")
    )


def per_class_pr(matches: DataFrame, truth: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """True/false positives, misses, precision and recall per class of either side."""
    p = matches.groupBy("class_id").agg(F.count_if("tp").alias("tp"), F.count("*").alias("n_pred"))
    t = truth.groupBy("class_id").agg(F.count("*").alias("n_truth"))
    both = p.join(t, "class_id", "full").fillna(0, ["tp", "n_pred", "n_truth"])
    out = both.select(
        "class_id",
        "tp",
        (F.col("n_pred") - F.col("tp")).alias("fp"),
        (F.col("n_truth") - F.col("tp")).alias("fn"),
        ratio(F.col("tp"), F.col("n_pred")).alias("precision"),
        ratio(F.col("tp"), F.col("n_truth")).alias("recall"),
    )
    return out if names is None else name_classes(out, names)


def name_classes(df: DataFrame, names: DataFrame) -> DataFrame:
    """Adds the class name; ids without one become ``Class <id>``."""
    default = F.concat(F.lit("Class "), F.col("class_id").cast("string"))
    return df.join(names.select("class_id", "class_name"), "class_id", "left").withColumn(
        "class_name", F.coalesce("class_name", default)
    )


def threshold_sweep(matches: DataFrame, truth: DataFrame, thresholds: Sequence[float] = (0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """Mean precision and recall over images for several score thresholds, in one pass.

    Suppression and matching look only at better-scored boxes, so dropping low scores
    before them gives the same flags as counting fewer rows of one matched table.
    """
    aggs = []
    for i, t in enumerate(thresholds):
        above = F.col("score") > t
        aggs += [F.count_if(above & F.col("tp")).alias(f"tp{i}"), F.count_if(above).alias(f"n{i}")]
    p = matches.groupBy("image_id").agg(*aggs)
    t = truth.groupBy("image_id").agg(F.count("*").alias("n_truth"))
    both = p.join(t, "image_id", "full")
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                ratio(F.col(f"tp{i}"), F.col(f"n{i}")).alias("precision"),
                ratio(F.col(f"tp{i}"), F.col("n_truth")).alias("recall"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return both.select(F.inline(rows)).groupBy("threshold").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall")
    )


def class_ap(matches: DataFrame, truth: DataFrame) -> DataFrame:
    """Average precision per class: precision times recall step over distinct scores.
    Classes without any prediction get 0."""
    counts = matches.groupBy("class_id", "score").agg(F.count("*").alias("n"), F.sum(F.col("tp").cast("bigint")).alias("hits"))
    cum = prefix_sums(counts, "score", ["n", "hits"], ["class_id"], descending=True)
    area = cum.groupBy("class_id").agg(F.sum(F.col("hits") * F.col("cum_hits") / F.col("cum_n")).alias("area"))
    t = truth.groupBy("class_id").agg(F.count("*").alias("n_truth"))
    return t.join(area, "class_id", "left").select("class_id", "n_truth", ratio(F.col("area"), F.col("n_truth")).alias("ap"))


def mean_ap(ap: DataFrame) -> DataFrame:
    return ap.agg(F.avg("ap").alias("map"), F.count("*").alias("classes"))


# ---- losses and mining ----------------------------------------------------------------------


def _many(pred: DataFrame, truth: DataFrame, crowd: int) -> DataFrame | None:
    """Images with more than ``crowd`` rows on both sides together; None when there are none. Only ids are shuffled."""
    ids = pred.select("image_id").unionAll(truth.select("image_id"))
    big = ids.groupBy("image_id").agg(F.count("*").alias("_n")).filter(F.col("_n") > crowd).select("image_id")
    n = big.limit(SMALL_TABLE + 1).count()
    if n == 0:
        return None
    return F.broadcast(big) if n <= SMALL_TABLE else big


def _merged(rows: DataFrame, big: DataFrame) -> DataFrame:
    """Equal rows of the ``big`` images as one with their number ``n``; rows of ordinary images, which need no aggregate, as they are."""
    few = rows.join(big, "image_id", "left_anti").withColumn("n", F.lit(1).cast("bigint"))
    return few.unionByName(rows.join(big, "image_id", "left_semi").groupBy(*rows.columns).agg(F.count("*").alias("n")))


def _pixel_sides(pred: DataFrame, truth: DataFrame, images: DataFrame, values: list[str], crowd: int, move: Callable[[DataFrame], DataFrame] | None = None):
    """Overlapping pairs of both sides in pixels with their values; equal rows of crowds are merged with a weight.

    ``move`` makes copies of annotations, with an ``augmentation``. They are made of the pairs, after the shuffles, but in crowds before the grid is laid.
    """
    p = pred.select("image_id", "class_id", "cx", "cy", "w", "h", *values)
    t = truth.select("image_id", "class_id", "cx", "cy", "w", "h")
    big = _many(pred, truth, crowd)
    if big is None:
        p, t = (rows.withColumn("n", F.lit(1).cast("bigint")) for rows in (p, t))
    else:
        p, t = _merged(p, big), _merged(t if move is None else move(t), big)
    box = ["class_id", "cx", "cy", "w", "h", "n"]
    a = _corners(*_boxed(p, "a", images), {**{f"p_{c}": F.col(c) for c in box}, **{v: F.col(v) for v in values}})
    if big is None and move is not None:
        sized = t.join(images.select("image_id", "width", "height"), "image_id").withColumnsRenamed({"class_id": "t_class_id", "n": "t_n"})
        both = move(a.join(sized, "image_id"))
        corners = pixel_corner(*_center(), F.col("width"), F.col("height"))
        # inline keeps the corners apart from what reads them: merged, the optimizer would compute each moved box dozens of times
        both = both.select("*", F.inline(F.array(F.struct(*[v.alias(f"b_{c}") for v, c in zip(corners, "xywh")]))))
        return _met(both.withColumnsRenamed({c: f"t_{c}" for c in ("cx", "cy", "w", "h")}))
    extra = {f"t_{c}": F.col(c) for c in box} | ({"augmentation": F.col("augmentation")} if "augmentation" in t.columns else {})
    b = _corners(*_boxed(t, "b", images), extra)
    return _pairs(a, b, (), None) if big is None else overlapping(a, b, crowd=crowd)


def detection_loss(
    pred: DataFrame,
    truth: DataFrame,
    images: DataFrame,
    iou_threshold: float = 0.5,
    lambda_bb: float = 1.0,
    lambda_obj: float = 1.0,
    lambda_cls: float = 1.0,
    lambda_no_obj: float = 0.5,
    crowd: int = CROWD,
    variants: Sequence[str] | None = None,
    move: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Mean loss per image over all prediction x annotation pairs.

    With ``variants`` there is a row per image and variant, named by ``augmentation``: ``move`` makes one copy of every annotation per variant, as ``augment_boxes``
    does, and the predictions are those of the image. The copies are not shuffled.

    Pairs without enough overlap all cost ``lambda_no_obj * score^2``, so their sum is
    n_truth * sum(score^2) and only overlapping pairs are built. Images with annotations
    only cost ``lambda_no_obj`` each; images without annotations cost 0.
    """
    pairs = _pixel_sides(pred, truth, images, ["score", "class_scores"], crowd, move if variants else None).filter(F.col("iou") > iou_threshold)
    d = [F.col(f"p_{c}") - F.col(f"t_{c}") for c in ("cx", "cy", "w", "h")]
    box = d[0] * d[0] + d[1] * d[1] + d[2] * d[2] + d[3] * d[3]
    inside = (F.col("t_class_id") >= 0) & (F.col("t_class_id") < F.size("class_scores"))
    chance = F.when(inside, F.get("class_scores", F.col("t_class_id"))).otherwise(
        F.raise_error(F.lit("annotation class outside the class scores")).cast("double")
    )
    score = F.col("score")
    cost = lambda_bb * box - lambda_cls * F.ln(chance + F.lit(1e-9)) + lambda_obj * (1 - score) * (1 - score)
    change = F.col("p_n") * F.col("t_n") * (cost - lambda_no_obj * score * score)
    per_variant = [F.sum(F.when(F.col("augmentation") == v, change)) for v in variants or ()]
    hits = pairs.groupBy("image_id").agg(F.array(*per_variant).alias("changes") if variants else F.sum(change).alias("change"))
    p = pred.groupBy("image_id").agg(F.count("*").alias("n_pred"), F.sum(score * score).alias("s2"))
    t = truth.groupBy("image_id").agg(F.count("*").alias("n_truth"))
    one = images.select("image_id").join(p, "image_id", "left").join(t, "image_id", "left").join(hits, "image_id", "left")
    if variants:
        one = one.select("image_id", "n_pred", "n_truth", "s2", F.inline(F.array(*[F.struct(F.lit(v).alias("augmentation"), F.col("changes")[i].alias("change")) for i, v in enumerate(variants)])))
    one = one.fillna(0, ["n_pred", "n_truth", "s2", "change"])
    both = (lambda_no_obj * F.col("n_truth") * F.col("s2") + F.col("change")) / (F.col("n_pred") * F.col("n_truth"))
    return one.select(
        "image_id",
        *(["augmentation"] if variants else []),
        "n_pred",
        "n_truth",
        F.when((F.col("n_pred") > 0) & (F.col("n_truth") > 0), both)
        .when(F.col("n_truth") > 0, lambda_no_obj * F.col("n_truth"))
        .otherwise(F.lit(0.0))
        .alias("loss"),
    )


def hard_negatives(losses: DataFrame, n: int = 10) -> DataFrame:
    """The n images with the largest loss (a top-k report)."""
    return losses.orderBy(F.col("loss").desc(), F.col("image_id")).limit(n)


def misclassified(pred: DataFrame, truth: DataFrame, images: DataFrame, iou_threshold: float = 0.5, crowd: int = CROWD) -> DataFrame:
    """Overlapping pairs of different class, counted per true class."""
    pairs = _pixel_sides(pred, truth, images, [], crowd)
    wrong = pairs.filter((F.col("iou") > iou_threshold) & (F.col("p_class_id") != F.col("t_class_id")))
    counts = wrong.groupBy(F.col("t_class_id").alias("class_id")).agg(
        F.sum(F.col("p_n") * F.col("t_n")).alias("misclassified")
    )
    return counts.orderBy(F.col("misclassified").desc(), "class_id")


def complete_images(images: DataFrame, pred_files: DataFrame, truth_files: DataFrame) -> DataFrame:
    """Images that have both a prediction and an annotation file (an empty file counts)."""
    return images.join(pred_files, "image_id", "left_semi").join(truth_files, "image_id", "left_semi")


def augmentation_effect(before: DataFrame, after: DataFrame) -> DataFrame:
    """Loss of every augmented image next to that of its source: after has (image_id, augmentation, loss)."""
    base = before.select("image_id", F.col("loss").alias("loss_before"))
    return after.select("image_id", "augmentation", F.col("loss").alias("loss_after")).join(base, "image_id").select(
        "image_id", "augmentation", "loss_before", "loss_after",
        (F.col("loss_after") - F.col("loss_before")).alias("change"),
    )


def augment_boxes(df: DataFrame, kinds: Sequence[str] | None = None) -> DataFrame:
    """One copy of every box per augmentation, moved as the picture is."""
    kinds = list(kinds or AUGMENTATIONS)
    out = df.withColumn("augmentation", F.explode(F.array(*[F.lit(k) for k in kinds])))
    kind = F.col("augmentation")
    flip, turn = kind == "flipped", kind == "rotated"
    return out.withColumns(
        {
            "cx": F.when(flip, 1 - F.col("cx")).when(turn, 1 - F.col("cy")).otherwise(F.col("cx")),
            "cy": F.when(turn, F.col("cx")).otherwise(F.col("cy")),
            "w": F.when(turn, F.col("h")).otherwise(F.col("w")),
            "h": F.when(turn, F.col("w")).otherwise(F.col("h")),
        }
    )


# Names of the six training augmentations.
AUGMENTATIONS = ["flipped", "blurred", "resized", "rotated", "brightness", "contrast"]


# ---- per-frame results ----------------------------------------------------------------------


def frame_results(boxes: DataFrame, frames: DataFrame, frame: str = "image_id") -> DataFrame:
    """One row per frame, whatever its boxes: parallel lists of boxes, classes and scores in score order."""
    item = F.struct((-F.col("score")).alias("neg"), "det_no", "cx", "cy", "w", "h", "class_id", "score")
    grouped = boxes.groupBy(frame).agg(F.array_sort(F.collect_list(item)).alias("d"))
    joined = frames.select(frame).join(grouped, frame, "left")
    d = F.coalesce("d", F.expr("array()").cast(grouped.schema["d"].dataType))
    return joined.select(
        F.col(frame).alias("frame_index"),
        F.transform(d, lambda s: F.array(s["cx"], s["cy"], s["w"], s["h"])).alias("bboxes"),
        F.transform(d, lambda s: s["class_id"]).alias("class_ids"),
        F.transform(d, lambda s: s["score"]).alias("scores"),
    )


def run_metrics(results: DataFrame, seconds: float) -> DataFrame:
    """Frames, frames per second (0 if no time) and mean confidence over all boxes (0 if none)."""
    totals = results.select(
        F.size("scores").cast("bigint").alias("n"), F.aggregate("scores", F.lit(0.0), lambda a, s: a + s.cast("double")).alias("s")
    )
    fps = F.count("*") / F.lit(float(seconds)) if seconds > 0 else F.lit(0.0)
    return totals.agg(
        F.count("*").alias("total_frames"),
        F.round(fps, 2).alias("fps"),
        F.round(F.coalesce(F.try_divide(F.sum("s"), F.sum("n")), F.lit(0.0)), 2).alias("average_confidence"),
    )
