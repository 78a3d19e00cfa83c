import math
import random

import pytest
from pyspark.sql import functions as F

from sparquill.functions import boxes as fb
from sparquill.operators import boxes as ob

PRED = "image_id bigint, det_no bigint, class_id int, cx double, cy double, w double, h double, score double, class_scores array<double>"
TRUTH = "image_id bigint, ann_no bigint, class_id int, cx double, cy double, w double, h double"


def plain_iou(a, b):
    dx = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
    dy = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    inter = max(dx, 0) * max(dy, 0)
    union = a[2] * a[3] + b[2] * b[3] - inter
    return inter / union if union else 0.0


def corner(r):
    return (r[0] - r[2] / 2, r[1] - r[3] / 2, r[2], r[3])


def make(seed, n_pred=60, n_truth=25, images=(1, 2)):
    """Image 1 holds most boxes, a third of them copies of one box."""
    rng = random.Random(seed)

    def box():
        return [round(rng.uniform(0.2, 0.8), 3), round(rng.uniform(0.2, 0.8), 3), round(rng.uniform(0.05, 0.4), 3), round(rng.uniform(0.05, 0.4), 3)]

    copy = box()
    pred, truth = [], []
    for i in images:
        for d in range(n_pred if i == 1 else 6):
            b = list(copy) if i == 1 and d % 3 == 0 else box()
            s = round(rng.choice([0.3, 0.5, rng.random()]), 3)
            pred.append((i, d, rng.randint(0, 2), *b, s, [0.2, 0.3, 0.5]))
        for a in range(n_truth if i == 1 else 3):
            near = rng.choice([p for p in pred if p[0] == i])
            b = [x + rng.uniform(-0.02, 0.02) for x in near[3:7]] if a % 2 else list(near[3:7])
            truth.append((i, a, near[2], *b))
    return pred, truth


def greedy(pred, t):
    kept = []
    for p in sorted((p for p in pred if p[7] > 0), key=lambda p: (p[0], -p[7], p[1])):
        if all(k[0] != p[0] or plain_iou(corner(k[3:7]), corner(p[3:7])) <= t for k in kept):
            kept.append(p)
    return {(p[0], p[1]) for p in kept}


@pytest.mark.parametrize("crowd", [4, 20, 5000])
def test_nms_equals_the_greedy_rule_for_small_and_crowded_images(spark, crowd):
    pred, _ = make(3)
    pred += [(1, 900, 0, 0.5, 0.5, 0.0, 0.1, 0.9, []), (1, 901, 0, 0.5, 0.5, 0.0, 0.1, 0.9, []), (2, 902, 0, 0.5, 0.5, 0.2, 0.2, 0.0, [])]
    df = spark.createDataFrame(pred, PRED)
    out = ob.nms(df, 0.4, crowd=crowd)
    got = {(r.image_id, r.det_no) for r in out.collect()}
    assert got == greedy(pred, 0.4)
    again = ob.nms(out, 0.4, crowd=crowd)
    assert {(r.image_id, r.det_no) for r in again.collect()} == got


def test_nms_keeps_a_box_exactly_at_the_threshold(spark):
    rows = [(1, 0, 0, 0.5, 0.5, 0.4, 0.4, 0.9, []), (1, 1, 0, 0.5, 0.5, 0.4, 0.2, 0.8, [])]  # IoU 0.5
    df = spark.createDataFrame(rows, PRED)
    iou = df.select(fb.iou(fb.corner(*map(F.lit, (0.5, 0.5, 0.4, 0.4))), fb.corner(F.col("cx"), F.col("cy"), F.col("w"), F.col("h")))).collect()[1][0]
    assert ob.nms(df, iou).count() == 2 and ob.nms(df, iou - 1e-9).count() == 1
    assert ob.nms(df.filter("det_no > 5")).count() == 0


@pytest.mark.parametrize("crowd", [5, 5000])
def test_pairs_of_a_crowd_equal_all_overlapping_pairs(spark, crowd):
    pred, truth = make(5)
    a = spark.createDataFrame(pred, PRED).select("image_id", "det_no", *[c.alias(f"a_{n}") for c, n in zip(fb.corner(*[F.col(x) for x in ("cx", "cy", "w", "h")]), "xywh")])
    b = spark.createDataFrame(truth, TRUTH).select("image_id", "ann_no", *[c.alias(f"b_{n}") for c, n in zip(fb.corner(*[F.col(x) for x in ("cx", "cy", "w", "h")]), "xywh")])
    got = sorted((r.image_id, r.det_no, r.ann_no) for r in ob.overlapping(a, b, crowd=crowd).collect())
    want = sorted((p[0], p[1], t[1]) for p in pred for t in truth if p[0] == t[0] and plain_iou(corner(p[3:7]), corner(t[3:7])) > 0)
    assert got == want


def plain_match(pred, truth, thr):
    out, taken = {}, set()
    for p in sorted(pred, key=lambda p: (p[0], -p[7], p[1])):
        best, at = 0.0, None
        for t in sorted(truth):
            if t[0] == p[0] and t[2] == p[2]:
                v = plain_iou(corner(p[3:7]), corner(t[3:7]))
                if v > best:
                    best, at = v, t[1]
        tp = at is not None and best >= thr and (p[0], at) not in taken
        if tp:
            taken.add((p[0], at))
        out[(p[0], p[1])] = (at, round(best, 9), tp)
    return out


@pytest.mark.parametrize("crowd", [5, 5000])
def test_match_first_claim_wins(spark, crowd):
    pred, truth = make(7)
    m = ob.match(spark.createDataFrame(pred, PRED), spark.createDataFrame(truth, TRUTH), 0.5, crowd)
    got = {(r.image_id, r.det_no): (r.best_ann, round(r.best_iou, 9), r.tp) for r in m.collect()}
    assert got == plain_match(pred, truth, 0.5)


def test_a_claimed_annotation_makes_the_next_prediction_false(spark):
    pred = spark.createDataFrame([(1, 0, 0, 0.5, 0.5, 0.2, 0.2, 0.6, []), (1, 1, 0, 0.5, 0.5, 0.2, 0.2, 0.9, [])], PRED)
    truth = spark.createDataFrame([(1, 0, 0, 0.5, 0.5, 0.2, 0.2), (2, 0, 1, 0.5, 0.5, 0.2, 0.2)], TRUTH)
    m = ob.match(pred, truth)
    assert {(r.det_no, r.tp) for r in m.collect()} == {(0, False), (1, True)}
    pr = {r.image_id: (r.precision, r.recall) for r in ob.image_pr(m, truth).collect()}
    assert pr == {1: (0.5, 1.0), 2: (0.0, 0.0)}
    cls = {r.class_id: (r.tp, r.fp, r.fn) for r in ob.per_class_pr(m, truth).collect()}
    assert cls == {0: (1, 1, 0), 1: (0, 0, 1)}
    assert ob.mean_ap(ob.class_ap(m, truth)).first()["map"] == 0.5


def plain_loss(pred, truth, width, height, thr=0.5, no_obj=0.5):
    def px(b):
        w, h = b[2] * width, b[3] * height
        return (int(b[0] * width - w / 2), int(b[1] * height - h / 2), int(w), int(h))

    losses = []
    for p in pred:
        for t in truth:
            if plain_iou(px(t[3:7]), px(p[3:7])) > thr:
                v = sum((x - y) ** 2 for x, y in zip(p[3:7], t[3:7])) - math.log(p[8][t[2]] + 1e-9) + (1 - p[7]) ** 2
            else:
                v = no_obj * p[7] ** 2
            losses.append(v)
    if not pred and truth:
        losses.append(no_obj * len(truth))
    return sum(losses) / len(losses) if losses else 0.0


@pytest.mark.parametrize("crowd", [5, 5000])
def test_loss_equals_the_mean_over_all_pairs(spark, crowd):
    pred, truth = make(11)
    truth += [(3, 0, 1, 0.5, 0.5, 0.1, 0.1), (3, 1, 1, 0.4, 0.5, 0.1, 0.1)]
    pred += [(4, 0, 1, 0.5, 0.5, 0.1, 0.1, 0.7, [0.1, 0.8, 0.1])]
    images = spark.createDataFrame([(i, 640, 480) for i in (1, 2, 3, 4, 5)], "image_id bigint, width int, height int")
    got = ob.detection_loss(spark.createDataFrame(pred, PRED), spark.createDataFrame(truth, TRUTH), images, crowd=crowd)
    for r in got.collect():
        want = plain_loss([p for p in pred if p[0] == r.image_id], [t for t in truth if t[0] == r.image_id], 640, 480)
        assert r.loss == pytest.approx(want, abs=1e-9)
    assert [r.image_id for r in ob.hard_negatives(got, 1).collect()] == [3]


def test_class_outside_the_scores_fails(spark):
    pred = spark.createDataFrame([(1, 0, 0, 0.5, 0.5, 0.2, 0.2, 0.6, [0.5])], PRED)
    truth = spark.createDataFrame([(1, 0, 3, 0.5, 0.5, 0.2, 0.2)], TRUTH)
    images = spark.createDataFrame([(1, 100, 100)], "image_id bigint, width int, height int")
    with pytest.raises(Exception, match="outside the class scores"):
        ob.detection_loss(pred, truth, images).collect()


def test_flip_twice_and_rotate_four_times_give_the_box_back(spark):
    df = spark.createDataFrame([(1, 0, 0, 0.25, 0.5, 0.125, 0.0625)], TRUTH)
    for kind, times in (("flipped", 2), ("rotated", 4)):
        out = df
        for _ in range(times):
            out = ob.augment_boxes(out, [kind]).drop("augmentation")
        assert out.collect() == df.collect()


def test_a_frame_is_one_row_at_any_size(spark):
    rows = [(1, d, 0, 0.5, 0.5, 0.1, 0.1, d / 5000, []) for d in range(5000)]
    boxes = spark.createDataFrame(rows, PRED)
    frames = spark.createDataFrame([(1,), (2,)], "image_id bigint")
    one = ob.frame_results(boxes, frames).collect()
    assert sorted((r.frame_index, len(r.scores)) for r in one) == [(1, 5000), (2, 0)]
    assert all(list(r.scores) == sorted(r.scores, reverse=True) for r in one)
    m = ob.run_metrics(ob.frame_results(boxes, frames), 0.0).first()
    assert (m.total_frames, m.fps, m.average_confidence) == (2, 0.0, 0.5)
    none = ob.run_metrics(ob.frame_results(boxes.filter("det_no < 0"), frames), 4.0).first()
    assert (none.fps, none.average_confidence) == (0.5, 0.0)


def test_postprocess_is_strict_and_takes_the_first_best_class(spark):
    df = spark.createDataFrame([(1, [0.5, 0.2]), (2, [0.6, 0.6])], "det_no bigint, class_scores array<double>")
    assert [(r.det_no, r.class_id) for r in ob.postprocess(df, 0.5).collect()] == [(2, 0)]


def test_class_names_have_a_default(spark):
    df = spark.createDataFrame([(0,), (9,)], "class_id int")
    names = spark.createDataFrame([(0, "helmet")], "class_id int, class_name string")
    assert {r.class_name for r in ob.name_classes(df, names).collect()} == {"helmet", "Class 9"}


def test_conflict_rounds_equal_the_greedy_rule(spark):
    pred, _ = make(13, n_pred=40, images=(1,))
    distinct = list({p[3:7]: p for p in pred}.values())
    df = spark.createDataFrame(distinct, PRED).withColumn("neg", -F.col("score"))
    left = df.select("image_id", "cx", "cy", "w", "h", "neg", "det_no")
    got = {(r.image_id, r.det_no) for r in ob._settle_pairs(left, 0.4, False, 5).collect()}
    assert got == greedy(distinct, 0.4)
