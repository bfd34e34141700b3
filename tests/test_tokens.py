import pytest
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from lectern.functions import tokens as tk
from lectern.operators import cleaning, wordcount
from lectern.plans.oracles import STOP_WORDS


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    rows = frame.select("i", expression(F.col("value")).alias("out")).orderBy("i").collect()
    return [row.out for row in rows]


def counts(frame):
    return {row["word"]: row["count"] for row in frame.collect()}


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_lines_end_as_a_line_reader_ends_them(spark):
    texts = ["", "\n", "a", "a\n", "a\n\n", "a\r\nb\rc"]
    assert column(spark, texts, tk.lines) == [[], [""], ["a"], ["a"], ["a", ""], ["a", "b", "c"]]


def test_word_count_of_the_sample(spark):
    sample = lines(spark, "Hello World Bye World", "Hello Hadoop Goodbye Hadoop")
    want = {"Hello": 2, "World": 2, "Hadoop": 2, "Bye": 1, "Goodbye": 1}
    assert counts(wordcount.word_count(sample)) == want


def test_word_count_drops_empty_tokens_and_keeps_other_spaces(spark):
    assert counts(wordcount.word_count(lines(spark, "", "  a\t\fb ", "c d"))) == {
        "a": 1, "b": 1, "c d": 1
    }


def test_split_keeps_leading_empties_only(spark):
    split = tk.regex_split
    assert column(spark, ["", "  a b ", "   ", "a"], split) == [[""], ["", "a", "b"], [], ["a"]]


def test_punctuation_goes_and_symbols_stay(spark):
    assert counts(wordcount.word_count_no_punct(lines(spark, "a.b-c$d+e's ..."))) == {"abc$d+es": 1}


def test_clean_words(spark):
    got = counts(wordcount.clean_words(lines(spark, "It's it''s end. THE the x1 é ' \n")))
    assert got == {"it's": 1, "the": 2, "'": 1}


def test_clean_word_count_order(spark):
    got = wordcount.clean_word_count(lines(spark, "b b c c a")).collect()
    assert [tuple(row) for row in got] == [("b", 2), ("c", 2), ("a", 1)]


def test_strip_boilerplate(spark):
    texts = [
        "Front\n*** START OF THIS ***\nbody\n*** end of this ***\nback",
        "Project Gutenberg's x\nProduced by y\n\nbody\nEnd of Project Gutenberg z",
        "This eBook is for the use of anyone\nx\n\n body End of the Project Gutenberg",
        "  plain *** stars \n",
        "Project Gutenberg’s text",
    ]
    assert column(spark, texts, tk.strip_boilerplate) == [
        "Front\n\nbody", "body", "body End of the Project Gutenberg", "plain *** stars",
        "Project Gutenberg’s text",
    ]


@pytest.mark.parametrize("hidden", ["*** ſTART OF x *** rest", "THIS EBOOKs", "a ProJect gutenberG's b"])
def test_hints_never_hide_a_match(spark, hidden):
    def unhinted(text):
        for pattern in tk.BOILERPLATE:
            text = F.regexp_replace(text, f"(?isu){pattern}", "")
        return tk.trim_unicode(text)

    assert column(spark, [hidden], tk.strip_boilerplate) == column(spark, [hidden], unhinted)


def test_normalize_equals_the_six_passes(spark):
    def passes(text):
        for pattern, blank in [
            (r"\n+", " "), (r"\s+", " "), (r"[^a-z\s]", " "), (r"\b\w{1,2}\b", ""), (r"\s+", " "),
        ]:
            text = F.regexp_replace(F.lower(text) if pattern == r"\n+" else text, pattern, blank)
        return F.trim(text)

    texts = ["", "A bc DEF ghij", "cafés naïve x\n\nyes-no's", " \t12 abc3def ghi_jkl ", "ab"]
    assert column(spark, texts, tk.normalize) == column(spark, texts, passes)


def test_tokens_equal_sparks_transformers(spark):
    texts = ["The Quick brown fox is  not an ox", "", "you and i were here again again"]
    frame = spark.createDataFrame([(t,) for t in texts], "cleaned_text string")
    ours = cleaning.remove_stop_words(cleaning.tokenize(frame))
    tokenizer = RegexTokenizer(inputCol="cleaned_text", outputCol="w", pattern=r"\s+", minTokenLength=3)
    remover = StopWordsRemover(inputCol="w", outputCol="f")
    theirs = remover.transform(tokenizer.transform(frame))
    assert [r.words for r in ours.collect()] == [r.w for r in theirs.collect()]
    assert [r.filtered_words for r in ours.collect()] == [r.f for r in theirs.collect()]


def test_oracle_stop_words_are_sparks(spark):
    plain = [w for w in tk.english_stop_words() if len(w) >= 3 and w.isalpha()]
    assert STOP_WORDS == plain


def test_clean_tokens_is_the_four_steps(spark):
    texts = ["x *** START OF q *** The cats, and dogs' ears!\n*** END OF q *** tail", "", "of the"]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    steps = cleaning.remove_stop_words(
        cleaning.tokenize(cleaning.normalize_text(cleaning.strip_boilerplate(frame)))
    )
    assert cleaning.clean_tokens(frame, "k").collect() == steps.select("k", "filtered_words").collect()


def test_words_of_a_batch_equal_the_plain_steps(spark):
    texts = ["", None, "ends with abc", "abc starts", "THE Straße of the éclair abcé\x00def", "ab cd e", "don't stop", "İstanbul Kelvin", " the "]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, value string").coalesce(1)
    plain = frame.select("i", tk.letter_words(F.col("value")).alias("words"))
    want = plain.select("i", tk.remove_stop_words("words", lowered=True).alias("out")).orderBy("i").collect()
    for part in (frame, frame.where("i % 2 = 1"), frame.where("i < 1"), frame.where("i < 0")):
        kept = {row.i for row in part.collect()}
        got = part.select("i", tk.clean_words(F.col("value")).alias("out")).orderBy("i").collect()
        assert got == [row for row in want if row.i in kept]
    words = frame.select(tk.clean_words(F.col("value")).alias("out"))
    assert "ArrowEvalPython" in words._jdf.queryExecution().executedPlan().toString()
