from pyspark.sql import functions as F

from sparquill.operators import boxes as ob


def tables(spark, images, copies):
    draw = lambda n: (F.xxhash64(F.lit(n), "i") % 100 + 100) / 400.0
    rows = spark.range(images * 6).select(F.col("id").alias("i"), (F.col("id") % images).alias("image_id"), (F.col("id") % 3).cast("int").alias("class_id"), *[draw(n).alias(c) for n, c in enumerate(("cx", "cy", "w", "h"))])
    rows = rows.withColumn("i", F.explode(F.array(*[F.lit(k) for k in range(copies)])))
    score = (F.col("class_id") + 1) / 4.0
    pred = rows.filter("cx < 0.35").withColumns({"det_no": F.col("i"), "score": score, "class_scores": F.array(score, score / 2, score / 3)})
    img = spark.range(images + 2).select(F.col("id").alias("image_id"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    return pred, rows.filter("cx >= 0.25").withColumnRenamed("i", "ann_no"), img


def found(df, *keys):
    return {tuple(r[k] for k in keys): (r["n_pred"], r["n_truth"], round(r["loss"], 9)) for r in df.collect()}


def test_losses_of_variants_are_those_of_their_own_copies(spark):
    kinds = ["flipped", "rotated", "contrast"]
    for copies, crowd in ((1, 2000), (4, 10)):
        pred, truth, img = tables(spark, 20, copies)
        got = found(ob.detection_loss(pred, truth, img, crowd=crowd, variants=kinds, move=lambda t: ob.augment_boxes(t, kinds)), "augmentation", "image_id")
        moved = ob.augment_boxes(truth, kinds)
        want = {(kind, *at): v for kind in kinds for at, v in found(ob.detection_loss(pred, moved.filter(F.col("augmentation") == kind), img), "image_id").items()}
        assert got == want and len(got) == 66


def test_ordinary_images_are_not_aggregated_by_box(spark):
    pred, truth, img = tables(spark, 20, 1)
    plan = ob.detection_loss(pred, truth, img)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Aggregate [image_id" in line and "cx" in line.split("]")[0]]
