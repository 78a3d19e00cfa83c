"""Line dedup, personal data, mixing, quality rules and sharding against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparquill.llm import line_dedup, mixing, pii, quality, shards, tokens

GAP = "[\\x20\\x09-\\x0D]"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(n, seed, words=("the", "of", "and", "to", "Éa", "tion", "ing", "house", "river,", "light.", "walks", "green")):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) for _ in range(n))


def near_copies_and_junk():
    rows = []
    for k in range(60):
        body = f"start {k} " + prose(80, k)
        rows += [(10 * k, body, "en", f"s{k % 4}"), (10 * k + 1, body.replace(" ", "  "), "en", f"s{k % 5}"), (10 * k + 2, body + " one more end", "en", None)]
        rows[-1 - k % 3] = (*rows[-1 - k % 3][:1], "shared  line\n" + rows[-1 - k % 3][1], *rows[-1 - k % 3][2:])
    return rows + [(9000, None, "en", "s1"), (9001, "short", "en", "s1"), (9002, "again and again " * 30, "en", "s2")]


# Line dedup


def line_rows():
    rows = [(i, f"Own {i}\n  COMMON line\t\n\nfoot") for i in range(12)]
    rows += [(100 + i, "nine times only") for i in range(9)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "foot"), (203, "foot"), (203, "other\nfoot"), (None, "foot\nx"), (None, "foot\nx"), (204, "É\r\n\x0bfoot\x0c"), (205, "É common LINE")]
    rows += [(206, "\n".join(f"l{k}" if k % 3 else "foot" for k in range(5000)))]
    return rows


def expected_lines(rows, min_docs=10, first=False):
    of = collections.defaultdict(set)
    strip = lambda s: re.sub(f"^{GAP}+|{GAP}+$", "", s).translate(LOWER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if strip(line):
                of[strip(line)].add(i)
    often = {k for k, v in of.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        out.append((i, len(lines), "\n".join(x for x in lines if strip(x) not in often)))
    return out


def test_line_digests(docs):
    rows = line_rows()
    got = sorted(((r.doc_id, r.n_lines, r.kept_sha256) for r in line_dedup.line_digests(docs(rows)).collect()), key=str)
    want = sorted(((i, n, hashlib.sha256(t.encode()).hexdigest()) for i, n, t in expected_lines(rows)), key=str)
    assert got == want
    dropped = {r.doc_id: r.n_dropped for r in line_dedup.line_digests(docs(rows)).collect()}
    assert dropped[0] == 2 and dropped[100] == 0 and dropped[206] == 1667 and dropped[200] == 0


def test_dropping_keeps_all_other_columns(docs):
    table = docs(line_rows())
    out = line_dedup.drop_lines(table)
    assert out.columns == table.columns
    assert sorted((r.doc_id, r.text) for r in out.where("doc_id is not null").collect()) == sorted((i, t) for i, _, t in expected_lines(line_rows()) if i is not None)
    assert out.where("doc = 7 and keep = 'k' and n_lines = 2").count() == len(line_rows())


def test_first_line_may_stay(docs):
    rows = [(i, f"a{i}\nsame") for i in range(10)]
    found = line_dedup.keep_bitmaps(docs(rows), keep="first")
    kept = {r.row.doc_id: r.kept for r in line_dedup.apply_bitmaps(docs(rows), found).collect()}
    assert kept[0] == ["a0", "same"] and all(kept[i] == [f"a{i}"] for i in range(1, 10))
    with pytest.raises(ValueError):
        line_dedup.keep_bitmaps(docs(rows), keep="last")


def test_lines_of_an_empty_table(docs):
    assert line_dedup.line_digests(docs([])).collect() == [] and line_dedup.drop_lines(docs([])).collect() == []


# Personal data

KINDS = [(k, re.compile(p)) for k, p in (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)]


def luhn(digits):
    double = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in double) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans(docs):
    draw = random.Random(5)
    alphabet = "0123456789 -.+()@ab1234 5555-é😀\n"
    rows = [(i, "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 150)))) for i in range(1500)]
    rows += [(5000, "a@b.cx_y@d.e 4111-1111-1111-1111 😀é +1 (555) 123-4567. 1.2.3.4.5 1.2.3.00255 1.2.3.256"), (5001, None), (5002, "x" * 3000 + "@a." + "b." * 3000), (5003, "1 " * 20000)]
    rows += [(None, "a@b.cc"), (5000, "+1234567890"), (5000, "+1234567890")]
    got = pii.pii_digests(docs(rows)).collect()
    want = collections.Counter((i, hashlib.sha256(base_spans(t).encode()).hexdigest()) for i, t in rows)
    assert collections.Counter((r.doc_id, r.base_sha256) for r in got) == want
    for r in got:
        said = [s for s in r.spans.split(",") if s]
        assert [sum(s.startswith(k) for s in said) for k in ("email", "ip", "card", "phone")] == [r.n_email, r.n_ip, r.n_card, r.n_phone]


def test_labels_discover_unseen_identifiers(docs):
    rows = [(i, f"ok\nContact: user{i}@mail.com and so on") for i in range(4)]
    rows += [(9, 'contact: jdoe4455x. And "contact" = 99xx11yy, later: nothing7777'), (10, "note: a12345b"), (11, "note: c12345d"), (12, "handle=99xx11yy"), (13, "handle=99xx11zz")]
    got = {r.doc_id: r.spans for r in pii.pii_digests(docs(rows)).collect()}
    assert got[9] == "found:9:18,found:36:44" and got[0].startswith("email:") and got[10] == got[11] == got[13] == ""


def test_no_personal_data_in_an_empty_table(docs):
    assert pii.pii_digests(docs([])).collect() == []


# Mixing


def expected_targets(sizes, cap=3):
    total, weight = sum(sizes.values()), {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    capped = set()
    while True:
        rest, left = total - sum(cap * sizes[s] for s in capped), sum(w for s, w in weight.items() if s not in capped)
        new = {s for s in sizes if s not in capped and cap * sizes[s] * left < weight[s] * rest}
        if not new:
            return {s: cap * sizes[s] if s in capped else weight[s] * rest / left for s in sizes}
        capped |= new


def test_mixing(docs):
    rows = [(i, prose(1 + i % 40, i), "en", ("b", "a", "é", None, "Z", "c")[i % 6 if i % 5 else 0]) for i in range(3000)] + [(9000, None, "en", "tiny"), (9001, "one", None, "tiny2"), (9002, "", "en", "b")]
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = expected_targets(dict(sizes))
    table = docs(rows).withColumn("size_", F.lit(1))
    got = mixing.mix_digests(table).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, len(WORD.findall(t or ""))) for i, t, *_ in rows)
    source, taken, spread = {i: s for i, _, _, s in rows}, collections.Counter(), collections.Counter()
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]], rel=1e-12) and r.taken <= 3 * r.size
        part = r.target / max(1, r.source_size) % 1
        taken[source[r.doc_id]] += r.taken
        spread[source[r.doc_id]] += part * (1 - part) * r.size**2
    for s in ("a", "b", "c", "Z", "é", None):
        assert abs(taken[s] - want[s]) <= 4 * spread[s] ** 0.5 + 1e-6
    assert got == mixing.mix_digests(table).collect()
    out = mixing.mix(docs(rows))
    assert out.columns == docs(rows).columns
    assert collections.Counter(r.doc_id for r in out.where("text <> ''").collect()) == {r.doc_id: r.taken // r.size for r in got if r.taken}


def test_mixing_an_empty_table_and_wordless_sources(docs):
    assert mixing.mix_digests(docs([])).collect() == []
    assert [tuple(r) for r in mixing.mix_digests(docs([(1, None, "en", None), (2, " ", "en", "a")])).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# Quality rules


def expected_base(text):
    words = WORD.findall(text or "")
    seen = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    cover = {j for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(cover)


def test_base_counts(docs):
    draw = random.Random(2)
    rows = [(i, "".join(draw.choice(("a ", "b ", "c\n", "Éé ", "#| ", "\x0b", " ", "日本 ", "\x1c")) for _ in range(draw.randint(0, 60))), "en") for i in range(400)]
    rows += [(900, None, "en"), (901, "", None), (902, "x " * 30, "de"), (902, "x " * 30, "de"), (None, prose(100, 1), "en"), (903, "w" * 300_000 + " " + prose(20000, 3), None)]
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(docs(rows)).collect())
    want = collections.Counter()
    for i, t, _ in rows:
        n, chars, symbols, dup, rep = expected_base(t)
        want[i, n, chars, symbols, dup, rep, n < 10 or 100 * rep > 20 * n] += 1
    assert got == want


def test_far_documents_are_rejected_and_clean_ones_stay(docs):
    clean = [(i, prose(120, i), "en") for i in range(150)]
    junk = [(1000 + i, " ".join(w + draw for w, draw in zip(prose(100, i).split(), "###$$$%%%&&&***" * 10, strict=False)).replace(" ", "$$$ ### "), "en") for i in range(3)]
    shout = [(2000, " ".join(f"{prose(1, k).upper()}{k}!!" for k in range(80)), "xx")]
    table = docs(clean + junk + shout + [(3000, None, None), (3001, "short text ###", "en")])
    verdict = {r.doc_id: r.kept for r in quality.judge(table).collect()}
    assert not any(verdict[i] for i, *_ in junk + shout) and not verdict[3000] and not verdict[3001]
    assert sum(verdict[i] for i, t, _ in clean) == sum(not (n < 10 or 100 * rep > 20 * n) for n, _, _, _, rep in (expected_base(t) for _, t, _ in clean))
    kept = quality.keep_good(table)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in verdict.items() if k)


def test_quality_of_small_and_empty_tables(docs):
    assert quality.judge(docs([])).collect() == [] and quality.keep_good(docs([])).collect() == []
    assert [r.kept for r in quality.judge(docs([(1, "one two three four five six seven eight nine ten eleven", "en")])).collect()] == [True]


def test_labelled_clean_documents_stay(spark, sf):
    """Held-out labels: documents of good quality are not rejected by distance, most bad ones of some length are."""
    sf = "/root/testdata/sf0.01"
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    good, lost = judged.where("quality = 1").agg(F.count(F.lit(1)), F.count_if(~F.col("kept"))).first()
    bad, caught = judged.where("quality = 0 and n_words >= 50").agg(F.count(F.lit(1)), F.count_if(~F.col("kept"))).first()
    assert good > 200 and lost == 0 and caught >= 0.4 * bad


def test_distance():
    same = quality.distance(np.array([[2, 2]]), np.array([0.5, 0.5]))[0]
    apart = quality.distance(np.array([[4, 0]]), np.array([0.0, 1.0]))[0]
    assert same == pytest.approx(0) and apart == pytest.approx(1)


def test_word_hashes_follow_the_bytes():
    texts = ["a bb a", None, "", "bb\ta\x0b\x0cÉ", " a"]
    seen = {}
    for _, data, offsets in tokens.blocks(pa.array(texts)):
        s, e, row = tokens.spans(data, offsets, tokens.GAP)
        words = [bytes(data[a:b]).decode() for a, b in zip(s, e, strict=True)]
        assert list(zip(row.tolist(), words, strict=True)) == [(0, "a"), (0, "bb"), (0, "a"), (3, "bb"), (3, "a"), (3, "É"), (4, "a")]
        for w, h in zip(words, tokens.hashes(data, s, e), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == 3


# Sharding


def test_shards(docs):
    rows = [(i, prose(1 + (i * 37) % 90, i)) for i in range(2000)] + [(5000 + i, "one hot text") for i in range(1500)] + [(7, "seven"), (7, "seven"), (None, "z"), (8000, None), (8001, ""), (8002, "é" * 20000)]
    got = shards.shard(docs(rows)).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None} and {r.shard for r in got} == set(range(16))
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(sizes.values()) / 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(sizes[k] - mean) < 0.12 * mean for k in range(16) if max(r["size"] for r in got if r.shard == k) < 0.5 * mean)
    spread = collections.defaultdict(set)
    for r in got:
        spread[r.text_crc32].add(r.shard)
    assert all(len(v) == 1 for c, v in spread.items() if c != zlib.crc32(b"one hot text"))


def test_repeated_rows_are_divided_too(docs):
    got = shards.shard(docs([(1, "same row")] * 800 + [(None, "no id")] * 300)).collect()
    assert max(collections.Counter(r.shard for r in got).values()) < 2.5 * len(got) / 16


def test_shards_of_the_given_tables_are_near_equal(spark, sf):
    got = shards.shard(spark.read.parquet(f"{sf}/documents.parquet")).groupBy("shard").agg(F.sum("size").alias("n"), F.max("size").alias("most")).collect()
    mean = sum(r.n for r in got) / 16
    assert len(got) == 16 and all(abs(r.n - mean) < 0.02 * mean for r in got if r.most < mean)


def test_large_records_are_dealt_first():
    to, quota = shards.dealt([50, 40, 30, 20, 10], 30, 3)
    have = [sum(s for s, k in zip([50, 40, 30, 20, 10], to, strict=True) if k == i) for i in range(3)]
    assert [h + q for h, q in zip(have, quota, strict=True)] == [60, 60, 60] and sum(quota) == 30
    assert shards.dealt([100], 20, 3)[1] == [0, 10, 10] and shards.dealt([], 30, 3) == ([], [10, 10, 10])


def test_shards_of_an_empty_table(docs):
    assert shards.shard(docs([])).collect() == []
