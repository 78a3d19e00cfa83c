"""The URL model on words that it has not seen."""

from sparquill.llm import urls


def accuracy(spark):
    """Each fold's words are in no training row: rows of two words are trained on only if both are of other folds."""
    table = urls.labelled_table(spark).collect()
    right = total = 0
    for k in range(3):
        held = {w for words in (urls.REFUSED, urls.TAKEN) for j, w in enumerate(words) if j % 3 == k}
        has = lambda u, ws: any(w in u for w in ws)
        rest = {w for w in (*urls.REFUSED, *urls.TAKEN) if w not in held}
        train = spark.createDataFrame([r for r in table if not has(r.url, held)], "url string, label double")
        test = spark.createDataFrame([(f"http://{w}-{w}.example/en/7", float(w in urls.REFUSED)) for w in sorted(held) if not has(w, rest)], "url string, label double")
        said = {r.page_id: r.verdict for r in urls.judge(test.selectExpr("url as page_id", "url"), train, rules=()).collect()}
        for r in test.collect():
            right += said[r.url] == ("block" if r.label else "allow")
            total += 1
    return right, total


def test_whole_words_held_out(spark):
    """Little carries over from word to word: better than chance is all that the word lists give, see the README."""
    right, total = accuracy(spark)
    print(right, total)
    assert total > 60 and right > 0.5 * total


def test_no_syllables_of_the_given_hosts():
    assert not {"tion", "ering", "thought", "and", "hand", "enter"} & set(urls.TAKEN)
