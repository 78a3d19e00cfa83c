"""Column expressions on text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space for Python's split(), what a term is, and
# the punctuation and articles an answer comparison ignores.
SPACE = r"(?U)[\s\x1c-\x1f]+"
TERM = r"[\p{L}\p{N}_]{2,}"
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
ARTICLES = r"(?<![\p{L}\p{N}_])(a|an|the)(?![\p{L}\p{N}_])"

# Default stop words: English function words. Any other list can be passed instead.
STOP_WORDS = """
about above after again against all also although always am among an and any are around as at
be because been before being below between both but by
can cannot could
did do does doing done down during
each either else ever every
few for from further
get go
had has have having he hence her here hers herself him himself his how however
if in into is it its itself
just
less
many may me might more moreover most much must my myself
neither never no nor not nothing now
of off often on once one only or other others otherwise our ours ourselves out over own
per perhaps
rather
same she should since so some something sometimes still such
than that the their theirs them themselves then there therefore these they this those though through thus to together too toward
under until up upon us
very via
was we well were what whatever when where whether which while who whole whom whose why will with within without would
yet you your yours yourself yourselves
""".split()


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row: an expression named inside a
    lambda would be computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def trim_ws(text: Column | str) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def words(text: Column | str) -> Column:
    """White-space separated words; none for blank text."""
    return F.filter(F.split(trim_ws(text), " "), lambda w: w != "")


def terms(text: Column | str, stop_words: list[str] | None = None) -> Column:
    """Lower-case terms of two or more letters, digits or underscores, without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    stop = STOP_WORDS if stop_words is None else stop_words
    return F.filter(found, lambda t: ~t.isin(stop)) if stop else found


def sentences(text: Column | str) -> Column:
    """Sentences by rule: a full stop, question or exclamation mark before a blank ends one."""
    mark = "\u0001"
    return F.filter(F.split(F.regexp_replace(trim_ws(text), r"([.!?]) ", f"$1{mark}"), mark), lambda s: s != "")


def answer_form(text: Column | str) -> Column:
    """Lower case, without punctuation and articles, single blanks."""
    bare = F.regexp_replace(F.lower(text), PUNCTUATION, "")
    return trim_ws(F.regexp_replace(bare, ARTICLES, " "))


def overlap_f1(a: Column | str, b: Column | str) -> Column:
    """F1 of the distinct terms two texts share (stop words kept), 0 if both have none."""
    def f1(sides: Column) -> Column:
        x, y = sides["x"], sides["y"]
        shared = F.size(F.array_intersect(x, y))
        return F.coalesce(F.try_divide(2.0 * shared, F.size(x) + F.size(y)), F.lit(0.0))

    x, y = F.array_distinct(terms(a, [])), F.array_distinct(terms(b, []))
    return once(F.struct(x.alias("x"), y.alias("y")), f1)


# Fixed value: the prompt template.
PROMPT = "Question: %s\n\nContext: %s\n\n"


def prompt(question: Column | str, context: Column | str) -> Column:
    """Question and comma-joined contexts in the fixed template."""
    return F.format_string(PROMPT, question, F.array_join(context, ", "))


def first_number(score: Column | str) -> Column:
    """First value of a number, a JSON map or a map of maps, as a number; 0 if there is none."""
    def head(c: Column) -> Column:
        return F.get(F.map_values(F.from_json(c, "map<string,string>")), F.lit(0))

    text = F.col(score) if isinstance(score, str) else score
    outer = F.when(F.trim(text).startswith("{"), head(text)).otherwise(text)
    inner = F.when(F.trim(outer).startswith("{"), head(outer)).otherwise(outer)
    return F.coalesce(inner.try_cast("double"), F.lit(0.0))
