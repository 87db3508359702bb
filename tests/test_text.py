import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import metrics, sentiment, signals, text


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Orders rose $41.6 million (3.2%)", "Orders rose  financial_number  ( percentage_number )"),
        ("$1,234.56 total", " financial_number , number  total"),
        ("Q2 2024 EPS of $1.42, up 12%", "Q2  number  EPS of  financial_number , up  percentage_number "),
        ("$8.4M and 3 billion", " financial_number  and  number "),
        ("", ""),
        (None, None),
    ],
)
def test_replace_numbers(spark, raw, expected):
    assert one(spark, raw, text.replace_financial_numbers("t")) == expected


def test_replace_numbers_with_commas(spark):
    assert one(spark, "$1,234.56 total", text.replace_financial_numbers("t", commas=True)) == " financial_number  total"


def test_clean_text(spark):
    assert one(spark, "Group\nSales: $8.4M in Q3!", text.clean_text("t")) == "group sales 8 4m in q3"
    assert one(spark, "Étion\tÇouelle – x", text.clean_text("t")) == "étion çouelle x"
    assert one(spark, None, text.clean_text("t")) is None


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Revenue climbed to $3.9 billion. Gross margin was 41.5%.", ""),
        (
            "We don't expect forward-looking customers' sales numbers, growth and income.",
            "expect customers sales numbers growth and income",
        ),
        ("Sales rose by $1,234.56 and 7% over last year again!", "sales rose financial_number and financial_number over last year again"),
        ("One 1 two 2 three 3 four 4", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_sentences(spark, raw, expected):
    assert one(spark, raw, text.clean_sentences("t")) == expected


def test_sentence_filter(spark):
    raw = "Too short. This sentence is long enough to stay. Our Safe Harbor statement is not to be kept here."
    assert one(spark, raw, text.filter_bad_sentences("t")) == "This sentence is long enough to stay."
    assert one(spark, raw, text.removed_share("t")) == pytest.approx(200 / 3)
    long = " ".join(["word"] * 101) + "."
    assert one(spark, long, text.filter_bad_sentences("t")) == ""


def test_tokenize(spark):
    assert one(spark, "The company reported weak demand", text.tokenize_text("t")) == ["The", "weak", "demand"]
    assert one(spark, "a b  c", text.tokenize_text("t", remove_stopwords=False)) == ["a", "b", "c"]
    assert one(spark, None, text.tokenize_text("t")) == []


def test_process(spark):
    raw = "Our sales came to $72 million last year."
    assert one(spark, raw, text.process_text("t")) == "our sales came to financial_number last year"
    assert one(spark, raw, text.process_text("t", tokenize=True)) == ["sales", "came", "financial_number", "last"]
    only = text.process_text("t", replace_numbers=False, filter_bad=False)
    assert one(spark, "Sales: $8.4M", only) == "sales 8 4m"
    assert one(spark, None, text.process_text("t", tokenize=True)) == []


def test_tokens_keep_digits_and_foreign_letters_apart(spark):
    raw = "Q2 abc2 naïve net_income The up Étion"
    assert one(spark, raw, text.word_tokens("t")) == ["q2", "abc2", "naïve", "net_income", "the", "up", "étion"]
    assert one(spark, raw, text.vocabulary_tokens("t")) == ["net_income"]
    assert one(spark, "aaa bbb ccc", text.with_bigrams(text.vocabulary_tokens("t"))) == [
        "aaa", "bbb", "ccc", "aaa bbb", "bbb ccc",
    ]
    assert one(spark, "", text.with_bigrams(text.vocabulary_tokens("t"))) == []


def test_chunks_cover_the_whole_text(spark):
    raw = "".join(chr(97 + i % 26) for i in range(33_047))
    chunks = one(spark, raw, text.text_chunks("t"))
    assert "".join(chunks) == raw
    assert all(len(c) == 512 for c in chunks[:-1])


def test_lexicon_scores(spark):
    scores = one(spark, "Revenue grew by 15% exceeding expectations.", sentiment.lexicon_scores("t"))
    assert scores["positive"] == pytest.approx(1 / 6)
    assert scores["net_sentiment"] == pytest.approx(1 / 6)
    assert scores["sentiment_ratio"] == 1.0
    both = one(spark, "risk", sentiment.lexicon_scores("t"))
    assert (both["negative"], both["uncertainty"]) == (1.0, 1.0)


@pytest.mark.parametrize("blank", [None, "", " \t\n "])
def test_blank_text(spark, blank):
    assert tuple(one(spark, blank, sentiment.analyze("t"))) == (0.0, 0.0, None, None, 0.0, 1.0)


def test_combined_scores(spark):
    df = spark.createDataFrame([("strong growth", 0.5, 0.1), ("weak", None, None)], "t string, p double, n double")
    merged = sentiment.combine_scores(sentiment.lexicon_scores("t"), sentiment.model_scores(F.col("p"), F.col("n")))
    rows = df.select(merged.alias("s")).collect()
    assert rows[0]["s"]["positive"] == 0.5 and rows[0]["s"]["sentiment_ratio"] == pytest.approx(0.5 / 0.101)
    assert rows[1]["s"]["negative"] == 1.0


def test_metrics(spark):
    found = F.struct(*metrics.financial_metrics("t").values())
    raw = "$2.5 billion in revenue and $3 million profit; growth of 15.5%"
    assert one(spark, raw, found).asDict() == {
        "revenue_dollar": "2.5", "profit_dollar": "3", "eps_dollar": None,
        "growth_percentage": "15.5", "margin_percentage": None,
    }
    raw = "Q1 results: Revenue: $10.5M (+15% YoY), EPS: $0.25 (+10%), Gross margin: 35%"
    assert one(spark, raw, found).asDict() == {
        "revenue_dollar": None, "profit_dollar": None, "eps_dollar": "0.25",
        "growth_percentage": None, "margin_percentage": "35",
    }
    assert one(spark, "$1.5B", metrics.metric_number("t")) == 1.5
    assert one(spark, "n/a", metrics.metric_number("t")) is None
    assert one(spark, "eps_dollar", metrics.metric_label("t")) == "Eps Dollar"


def test_signals(spark):
    raw = "Revenue growth was strong. Guidance: raising the outlook. Margin expanded. We face challenge ahead."
    assert one(spark, raw, signals.insight_flags("t")) == [
        "revenue_up", "margin_up", "guidance_raised",
    ]
    phrases = one(spark, raw, signals.sentiment_phrases("t"))
    assert phrases["positive_phrases"] == ["Revenue growth was strong"]
    assert phrases["negative_phrases"] == ["We face challenge ahead"]
    assert one(spark, raw, signals.named_factors("t")) == ["growth", "guidance_raised", "margin_up"]
    assert one(spark, "nothing", signals.named_factors("t")) == []
    topics = one(spark, raw, signals.keyword_topics("t"))
    assert [(t["topic_id"], t["hits"]) for t in topics] == [(0, 2), (4, 2)]
    assert one(spark, "x", signals.insight_flags("t")) == [signals.NO_INSIGHT]
    assert [one(spark, "x", signals.score_band(F.lit(v))) for v in (-0.6, -0.5, 0.2, 0.21)] == [
        "strong_down", "slight_down", "neutral", "slight_up",
    ]


def test_normalised_polarity(spark):
    def run(p, u, n, net):
        shares = sentiment.normalised_polarity(F.lit(p), F.lit(u), F.lit(n), F.lit(net))
        return tuple(one(spark, "x", shares))

    assert run(0.2, 0.1, 0.1, 0.0) == pytest.approx((0.5, 0.25, 0.25))
    assert run(0.0, 0.0, 0.0, -0.4) == (0.0, 0.0, 1.0)
    assert run(0.0, 0.0, 0.0, 0.0) == (0.0, 1.0, 0.0)
