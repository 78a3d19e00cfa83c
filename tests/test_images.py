import numpy as np
import pytest

from sparquill.operators import images as oi

RNG = np.random.default_rng(2)
IMG = RNG.integers(0, 256, size=(6, 4, 3)).astype(np.uint8)


def test_flip_twice_and_rotate_four_times():
    assert (oi.augmented(oi.augmented(IMG, "flipped"), "flipped") == IMG).all()
    out = IMG
    for _ in range(4):
        out = oi.augmented(out, "rotated")
    assert (out == IMG).all()
    assert (oi.augmented(IMG, "rotated")[0, -1] == IMG[0, 0]).all()  # clockwise


def test_brightness_saturates_and_keeps_hue():
    img = np.array([[[0, 0, 0], [250, 125, 0], [100, 50, 20]]], np.uint8)
    assert oi.brighten(img).tolist() == [[[30, 30, 30], [255, 128, 0], [130, 65, 26]]]


def test_contrast_saturates():
    assert oi.augmented(np.array([[[10, 100, 200]]], np.uint8), "contrast").tolist() == [[[15, 150, 255]]]
    flat = np.full((3, 3, 3), 90, np.uint8)
    assert (oi.distorted(flat, "contrast", 0.5) == 90).all()
    assert (oi.distorted(flat, "brightness", 1.5) == 135).all()


def test_blur_and_resize_keep_a_flat_picture_and_the_mean():
    flat = np.full((9, 7, 3), 77, np.uint8)
    assert (oi.augmented(flat, "blurred") == 77).all() and (oi.distorted(flat, "blur", 2) == 77).all()
    big = oi.augmented(flat, "resized")
    assert big.shape == (224, 224, 3) and (big == 77).all()
    one = np.zeros((31, 31, 3), np.uint8)
    one[15, 15] = 255
    b = oi.blur(one, 2.6, 7).astype(int)
    assert b[15, 15, 0] == b.max() and (b[15, 14] == b[15, 16]).all() and (b[14, 15] == b[15, 14]).all()


def test_doubling_by_linear_interpolation():
    img = np.array([[[0] * 3, [100] * 3]], np.uint8)
    assert oi.resize(img, (1, 4))[0, :, 0].tolist() == [0, 25, 75, 100]


def test_tensor_is_normalized_rgb():
    red = np.zeros((5, 5, 3), np.uint8)
    red[:, :, 2] = 255  # BGR
    t = oi.tensor(red, 4).reshape(3, 4, 4)
    assert t[0] == pytest.approx(np.full((4, 4), (1 - 0.485) / 0.229), abs=1e-5)
    assert t[2] == pytest.approx(np.full((4, 4), -0.406 / 0.225), abs=1e-5)


def test_unknown_kinds(spark):
    with pytest.raises(ValueError):
        oi.augmented(IMG, "sheared")
    with pytest.raises(ValueError):
        oi.distorted(IMG, "sheared", 1)


def test_every_picture_gets_every_variant(spark, monkeypatch):
    monkeypatch.setattr(oi, "BATCH_BYTES", 100)
    rows = [(f"d/p{i}.jpg", 6, 4, 3, 16, bytearray(np.ascontiguousarray(np.roll(IMG, i, 0)).tobytes())) for i in range(5)]
    df = spark.createDataFrame(rows, oi.IMAGE_FIELDS)
    out = oi.augment(df).collect()
    assert len(out) == 30 and {r.augmentation for r in out} == set(oi.AUGMENTATIONS)
    flip = next(r for r in out if r.origin == "d/p0.jpg" and r.augmentation == "flipped")
    assert (oi.pixels(flip.height, flip.width, 3, flip.data) == IMG[:, ::-1]).all()
    assert oi.robustness_variants(df).count() == 25
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 for r in oi.embed_image(df).collect())
