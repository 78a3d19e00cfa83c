"""Personal data: four kinds by pattern, and contextual bootstrapping for what has no fixed form.

The spans of the four kinds are seeds. A lexical pattern is a label in front of a value ("email: ", "token = "), also inside another label's value, or the
two words before a value or after it ("account number 12345678"). Labels have all their values, words the seeds and the identifier-like tokens
beside them; patterns and values of the corpus form a bipartite graph. Round by round, a pattern is scored by the share of its distinct values that are
known; patterns that score high make their other identifier-like values known, and these may vouch for further patterns, until no value is new.
New values become spans; base spans always stay.

Everything runs in Spark's own expressions. Patterns start only where a run of their first characters starts or the last match ended, and their last
groups are possessive: linear time and no deep recursion on texts of any length, with the matches of the plain patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import discard, stored

# The base kinds in their order, by the contract. (?:(?<![...])|\G) only spares attempts inside a run that failed at its start.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
#: A label, a separator, and the value as far as it has no white space, quotes or brackets.
LABEL = r"(?<![A-Za-z0-9_-])[A-Za-z][A-Za-z0-9_-]{1,30}+[\"']?\x20?[:=]\x20?[\"'(<\[]?[^\x20\x09-\x0D\"'()<>\[\],;]++"
VALUE = r"^[A-Za-z][A-Za-z0-9_-]*[\"']?\x20?[:=]\x20?[\"'(<\[]?"
#: A label inside another label's value, and its value's characters.
INNER = r"(?<![A-Za-z0-9_-])[A-Za-z][A-Za-z0-9_-]{1,30}+[:=]"
#: A token that may be an identifier: a run without white space, quotes, brackets, commas and semicolons, with a digit.
TOKEN = r"(?<![^\x20\x09-\x0D\"'()<>\[\],;])(?=[^\x20\x09-\x0D\"'()<>\[\],;0-9]*+[0-9])[^\x20\x09-\x0D\"'()<>\[\],;]{6,}+"
#: The two words beside a value, as far as they are looked for, and what separates them from it.
BEFORE, AFTER, WIDTH = r"([\p{L}']+[^\p{L}\p{N}.!?;]+[\p{L}']+)[^\p{L}\p{N}.!?;]{1,3}$", r"^[^\p{L}\p{N}.!?;]{1,3}([\p{L}']+[^\p{L}\p{N}.!?;]+[\p{L}']+)", 64
#: Cheap tests that a text can have a match at all.
GATES = {"email": "@", "phone": "+"}
#: A label is trusted with this share of known values, and this many of them.
CONFIDENCE, SUPPORT = 0.6, 3
#: An unseen identifier has a digit and at least this many characters.
MIN_IDENTIFIER = 6

LUHN = """aggregate(transform(sequence(1, length({d})), i -> cast(substr(reverse({d}), i, 1) as int) * (2 - i % 2)), 0, (s, x) -> s + x - if(x > 9, 9, 0)) % 10 = 0"""


def _matches(docs: DataFrame) -> DataFrame:
    """(doc, sig, kind, start, end, match, before, after) of all matches of all patterns, positions in code points, the end exclusive; before and after
    are the ends of the gaps beside it.

    A match's place follows from the lengths of the gaps and matches before it, summed per text after they are laid out as rows.
    """
    patterns = {**KINDS, "label": LABEL, "token": TOKEN}
    text = F.col("text")
    none = F.array().cast("array<string>")
    found = {}
    for kind, pattern in patterns.items():
        every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        found[kind] = F.when(F.instr(text, GATES[kind]) > 0, every).otherwise(none) if kind in GATES else every
    rows = docs.select("doc", "sig", "text", *[m.alias(f"m_{k}") for k, m in found.items()])
    rows = rows.where(" or ".join(f"size(m_{k}) > 0" for k in patterns))
    each = [F.struct(F.lit(k).alias("kind"), F.col(f"m_{k}").alias("m"), F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)).alias("g")) for k, p in patterns.items()]
    laid = rows.select("doc", "sig", F.explode(F.array(*each)).alias("x")).where("size(x.m) > 0").select("doc", "sig", "x.*")
    laid = laid.select("doc", "sig", "kind", F.expr(f"posexplode(transform(m, (s, i) -> named_struct('match', s, 'gap', length(g[i]), 'before', right(g[i], {WIDTH}), 'after', left(g[i + 1], {WIDTH}))))").alias("i", "x"))
    laid = laid.select("doc", "sig", "kind", "i", "x.match", "x.gap", "x.before", "x.after").dropDuplicates(["doc", "sig", "kind", "i"])
    return laid.selectExpr(
        "doc", "sig", "kind", "match", "before", "after",
        "cast(sum(gap + length(match)) over (partition by doc, sig, kind order by i) as long) as end",
    ).withColumn("start", F.col("end") - F.length("match"))


def _valid(kind: Column, match: str = "match") -> Column:
    digits = f"regexp_replace({match}, '[^0-9]', '')"
    parts = f"forall(split({match}, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)"
    card = f"length({digits}) between 14 and 19 and {LUHN.format(d=f'left({digits}, 19)')}"
    return (
        F.when(kind == "email", F.lit(True)).when(kind == "ip", F.expr(parts)).when(kind == "card", F.expr(card)).when(kind == "phone", F.expr(f"length({digits}) between 10 and 15"))
    )


def _inner(labels: DataFrame) -> DataFrame:
    """(doc, sig, label, value, start) of the labels inside the values of others, as in an address; their values end where the next one or a part of the address begins."""
    nested = labels.where(F.col("value").rlike(INNER)).select("doc", "sig", F.col("start").alias("base"), F.regexp_extract_all("value", F.lit(INNER), F.lit(0)).alias("h"), F.split("value", INNER, -1).alias("g"))
    laid = nested.select("doc", "sig", "base", F.expr("posexplode(transform(h, (s, i) -> named_struct('head', s, 'gap', length(g[i]), 'value', g[i + 1])))").alias("i", "x"))
    placed = laid.selectExpr("doc", "sig", "x.head", "x.value", "cast(base + sum(x.gap + length(x.head)) over (partition by doc, sig, base order by i) as long) as start")
    return placed.select("doc", "sig", F.lower(F.expr("left(head, length(head) - 1)")).alias("label"), F.regexp_extract("value", r"^[^&?#|]*", 0).alias("value"), "start")


def _contexts(spans: DataFrame) -> DataFrame:
    """(doc, sig, label, value, start, end): the words beside seeds and identifier-like tokens."""
    seeds = spans.where("kind not in ('label', 'token')").where(_valid(F.col("kind"))).withColumn("value", F.col("match"))
    tokens = spans.where("kind = 'token'").withColumn("value", F.regexp_replace("match", r"[.:!?]+$", ""))
    sides = F.array(
        F.concat(F.lit("< "), F.lower(F.regexp_extract("before", BEFORE, 1))), F.concat(F.lit("> "), F.lower(F.regexp_extract("after", AFTER, 1))),
    )
    laid = [x.select("doc", "sig", F.explode(sides).alias("label"), "value", "start", (F.col("start") + F.length("value")).alias("end")).where("length(label) > 2") for x in (seeds, tokens)]
    return laid[0].unionByName(laid[1]).distinct()


def _discovered(spans: DataFrame, base: DataFrame) -> DataFrame:
    """(doc, sig, start, end) of unseen identifiers, by rounds over the graph of patterns and values."""
    labels = spans.where("kind = 'label'").withColumn("head", F.regexp_extract("match", VALUE, 0)).where("length(head) < length(match)")
    labels = labels.select(
        "doc", "sig", F.lower(F.regexp_extract("head", r"^[A-Za-z0-9_-]+", 0)).alias("label"), F.expr("substr(match, length(head) + 1)").alias("value"),
        (F.col("start") + F.length("head")).alias("start"),
    )
    labels = labels.unionByName(_inner(labels)).withColumn("value", F.regexp_replace("value", r"[.:!?]+$", "")).where("value <> ''")
    labels = labels.withColumn("end", F.col("start") + F.length("value"))
    uses = stored(labels.unionByName(_contexts(spans)), "label-uses")
    graph = stored(uses.select("label", "value").distinct(), "label-graph")
    like = (F.length("value") >= MIN_IDENTIFIER) & F.col("value").rlike("[0-9]")
    inside = [F.col("u.doc").eqNullSafe(F.col("b.doc")), F.col("u.sig") == F.col("b.sig"), F.col("u.start") < F.col("b.end"), F.col("b.start") < F.col("u.end")]
    condition = inside[0] & inside[1] & inside[2] & inside[3]
    # The value of a label is known if a base span covers its start; a phone number or card has spaces and goes on behind the value.
    known = stored(uses.alias("u").join(base.alias("b"), condition).select(F.col("u.value").alias("value")).distinct(), "known-values")
    n = known.count()

    def trusted() -> DataFrame:
        scored = graph.join(known.withColumn("known", F.lit(1)), "value", "left").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("k"))
        return scored.where((F.col("k") >= SUPPORT) & (F.col("k") >= CONFIDENCE * F.col("n"))).select("label")

    while n:  # the set only grows and all its values are the graph's, so this ends
        new = stored(known.unionByName(graph.join(trusted(), "label", "left_semi").where(like).select("value")).distinct(), "known-values")
        more = new.count()
        discard(known)
        known = new
        if more == n:
            break
        n = more
    found = uses.join(trusted(), "label", "left_semi").where(like)
    return found.alias("u").join(base.alias("b"), condition, "left_anti").select("doc", "sig", "start", "end").distinct()


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, sig, kind, start, end): base spans of the four kinds, and discovered ones of kind 'found'.

    ``doc`` and ``sig`` (a hash of the text) name a row; rows equal in both share their spans.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("sig"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = stored(_matches(rows), "pii-matches")
    base = stored(spans.where("kind <> 'label'").where(_valid(F.col("kind"))).select("doc", "sig", "kind", "start", "end"), "pii-base")
    return base.unionByName(_discovered(spans, base).select("doc", "sig", F.lit("found").alias("kind"), "start", "end"))


def pii_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found; one row per input row.

    Null and empty texts have no spans: counts of 0, the hash of the empty string, empty spans. Rows without an id and repeated rows are searched like others.
    """
    spans = personal_spans(docs, id_col, text_col)
    order = "cast(array_position(array('email', 'ip', 'card', 'phone', 'found'), kind) as int)"
    entry = F.struct("start", F.expr(order).alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("said"))
    found = spans.groupBy("doc", "sig").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in (*KINDS, "found")], F.array_sort(F.collect_list(entry)).alias("all"),
    )
    found = found.select(
        "doc", "sig", *[f"n_{k}" for k in (*KINDS, "found")], F.expr("array_join(transform(filter(all, x -> x.rank < 5), x -> x.said), ',')").alias("base"), F.expr("array_join(transform(all, x -> x.said), ',')").alias("spans"),
    )
    rows = docs.select(F.col(id_col).alias("l_doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("l_sig"))
    out = rows.join(found, F.col("l_doc").eqNullSafe(F.col("doc")) & (F.col("l_sig") == F.col("sig")), "left")
    return out.select(
        F.col("l_doc").alias("doc_id"), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"),
    )
