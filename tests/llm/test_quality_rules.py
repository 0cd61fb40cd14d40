import re
from collections import Counter

import pytest

from strata.llm import quality_rules as rules

GOOD = "the cat and the dog of a house in the garden is here and that was it for the whole long day"
WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if re.search(WORD, line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_stop_words": sum(w in rules.STOP_WORDS for w in words),
        "longest_word": max(map(len, words), default=0),
        "n_repeat_words": len(covered),
        "one": 1,
    }


TEXTS = [
    None, "", " \n\t ", "one", GOOD, GOOD + "\n" + GOOD, "a b c d e f g h " * 5, "x " * 3000,
    "é ü 漢字 " * 10 + GOOD, "\n".join(["same line here"] * 9 + [GOOD]), "# $ % & | < > * " * 9,
    "a\x1cb c\xa0d \x85 e", GOOD.replace(" ", "\x0b"), "w" * 500 + " " + GOOD, GOOD + " \r\n" + GOOD + " \r\n" + GOOD,
    " ".join(str(n) for n in range(20000)), " ".join(f"w{n % 5000}" for n in range(20000)),
]


@pytest.fixture(scope="module")
def judged(spark):
    schema = "id int, text string, n_words string, kept string, w int"
    df = spark.createDataFrame([(i, t, "x", None, 3) for i, t in enumerate(TEXTS)], schema)
    out = rules.judge(df)
    assert set(df.columns) < set(out.columns)
    return {r.id: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_counts(judged, i):
    assert judged[i].quality.counts.asDict() == plain(TEXTS[i])
    assert (judged[i].n_words, judged[i].kept, judged[i].w) == ("x", None, 3)


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_verdict(judged, i):
    counts, verdict = plain(TEXTS[i]), judged[i].quality
    failed = counts["n_words"] < 20 or 100 * counts["n_repeat_words"] > 30 * counts["n_words"]
    kept = not failed
    for rule in rules.RULES:
        top, bottom = counts[rule.numerator], counts[rule.denominator]
        holds = (rule.least is None or top >= rule.least * bottom) and (
            rule.most is None or top <= rule.most * bottom
        )
        assert verdict.rules[rule.name] == holds
        kept = kept and holds
    assert (verdict.base_failed, verdict.kept) == (failed, kept)


def test_good_text_stays_and_junk_goes(judged):
    assert judged[4].quality.kept
    assert not any(judged[i].quality.kept for i in (0, 1, 6, 7, 10, 13))


def test_filters_stay_above_the_counts(spark):
    """A filter below them would make the arrays anew for each of their elements."""
    df = spark.createDataFrame([(1, GOOD), (2, "x")], "id int, text string")
    kept = rules.judge(df).where("quality.kept")
    assert [r.id for r in kept.collect()] == [1]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate") and plan.count("transform(") < 12


@pytest.mark.parametrize("word", ["Python", "Arrow", "Pandas", "Exchange"])
def test_plan_is_native_and_moves_nothing(spark, word):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert word not in plan


def test_empty_table_and_clashing_name(spark):
    df = spark.createDataFrame([], "id int, text string")
    assert rules.judge(df).count() == 0
    with pytest.raises(ValueError):
        rules.judge(df, into="id")


RUSSIAN = "это обычный текст на русском языке в котором нет ни одного слова из списка и он должен остаться здесь потому что он хороший"
POLISH = "zażółć gęślą jaźń i proszę bardzo żeby ten zupełnie zwykły polski tekst został ponieważ jest całkiem dobry więc można go zachować tutaj"
ASCII = (
    "yksi kaksi kolme nelja viisi kuusi seitseman kahdeksan yhdeksan kymmenen alku loppu talo vene "
    "kala lintu metsa meri taivas maa tuli vesi ilma kivi puu"
)
LONG = " ".join(f"the word {n} of a text" for n in range(100))
CORPUS = [
    (GOOD, "en", True), (GOOD.upper(), "en", True), (RUSSIAN, "ru", True), (RUSSIAN, None, True), (RUSSIAN, "en", True),
    (POLISH, "pl", True), (POLISH, None, True), (ASCII, "fi-FI", True), (ASCII, "en", False), (ASCII, None, False),
    (LONG + " " + "k" * 1200, "en", True), (LONG + " data:image/png;base64," + "A" * 1500, "en", True),
    (GOOD + " " + "w" * 500, "en", False), (LONG + " " + "w" * 9000, "en", False), (None, None, False),
]


def test_corpus_rules(spark):
    import corpus_pipeline

    rows = [(i, t, lang) for i, (t, lang, _) in enumerate(CORPUS)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.keep_good(spark, docs, "").collect()}
    assert kept == {i for i, (_, _, good) in enumerate(CORPUS) if good}
    # Without a column lang the text alone tells.
    kept = {r.doc_id for r in corpus_pipeline.keep_good(spark, docs.drop("lang"), "").collect()}
    assert kept == {i for i, (_, _, good) in enumerate(CORPUS) if good} - {7}
