"""Personal data found by bootstrapping: long chains, contexts of words, labels inside values."""

from sparquill.llm import pii


def spans(docs, rows):
    return {r.doc_id: r.spans for r in pii.pii_digests(docs(rows)).collect()}


def test_chains_of_any_length(docs):
    """Each label's known values make the next one's known, for nine labels."""
    rows = [(k, f"lab-a: user{k}@mail.com") for k in range(3)] + [(10 + k, f"lab-a: id0{k}xxx") for k in range(2)]
    for n in range(1, 9):
        step = [f"id{n - 1}{k}xxx" for k in range(2)] + (["user0@mail.com"] if n == 1 else ["user1@mail.com"])
        new = [f"id{n}{k}xxx" for k in range(2)]
        rows += [(100 * n + k, f"lab-{chr(97 + n)}: {v}") for k, v in enumerate(step + new)]
    got = spans(docs, rows)
    for n in range(1, 9):
        assert [got[100 * n + k].startswith("found:7:14") for k in (3, 4)] == [True, True]


def test_words_beside_a_value(docs):
    rows = [(k, f"Please call me on +1 212 555 01{k}0 or write") for k in range(4)] + [(9, "so call me on 5550199x then"), (10, "He paid 12345678 for it")]
    rows += [(20 + k, f"with mail{k}@x.org as login name, today") for k in range(4)] + [(29, "and jdoe4455 as login name, today")]
    got = spans(docs, rows)
    assert got[9] == "found:14:22" and got[29] == "found:4:12" and got[10] == ""


def test_labels_inside_values(docs):
    rows = [(k, f"token=user{k}@mail.com") for k in range(3)] + [(9, "https://x?token=ab12cd&x=5 was"), (10, "https://x?other=ab12ce")]
    got = spans(docs, rows)
    assert got[9] == "found:16:22" and got[10] == ""
