"""Column rules against the semantic vectors of FIXTURES.md §4 and Unicode categories."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from marquee.functions import scoring, text
from marquee.functions.stopwords import ENGLISH_STOP_WORDS

def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def apply(spark, values, expr, dtype="string"):
    rows = one_col(spark, values, dtype).select("i", expr(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


def test_stop_list_is_sparks_default_english_list(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_clean_description_vectors(spark):
    got = apply(spark, ["A young girl's dream, the BIG city café 2020", None, "", "   ", "ox go sky"],
                text.clean_description)
    assert got == ["young big city café", "", "", "", "sky"]


def test_title_vocabulary_vectors(spark):
    got = apply(spark, ["Spider-Man: No Way Home 2", "Café", None], text.title_vocabulary_tokens)
    assert got == [["spiderman", "way", "home"], ["caf"], []]


def test_title_score_token_vectors(spark):
    got = apply(spark, ["Spider-Man: No Way Home 2", "Café", None], text.title_score_tokens)
    assert got == [["way", "home"], ["café"], []]


def test_genre_terms(spark):
    got = apply(spark, ["Drama, Comedy,,Drama ", None, "\tAction ,  "], text.genre_terms)
    assert got == [["Drama", "Comedy", "Drama"], [], ["\tAction"]]
    got = apply(spark, ["Drama, Comedy,,Drama ", None, "\tAction ,　"], text.genre_score_terms)
    assert got == [["Drama", "Comedy", "", "Drama"], [], ["Action", ""]]


def test_year_points_vectors(spark):
    years = ["1999", "2000", "2005", "2006", "2010", "2011", "2015", "2016", "2021", "2022",
             None, "n/a", "2020.0", " 2020 ", "+2020", "\t2020\n", "2_020", "99999999999999999999",
             "-2020", "20 20"]
    got = apply(spark, years, scoring.year_points)
    assert got == [0, 5, 5, 10, 10, 15, 15, 20, 20, 0, 0, 0, 0, 20, 20, 20, 20, 0, 0, 0]


def test_year_points_numeric_input(spark):
    assert apply(spark, [2003, 2019, 1990], scoring.year_points, "int") == [5, 20, 0]


def test_success_vectors(spark):
    df = spark.createDataFrame([(0, 0, 200), (27, 0, 200), (200, 0, 200), (5, 5, 5), (3, 1, 1)],
                               "t int, lo int, hi int")
    got = [r.s for r in df.select(scoring.success(F.col("t"), F.col("lo"), F.col("hi")).alias("s"))
           .collect()]
    assert got == [60.0, 64.73, 95.0, 77.5, 77.5]


def test_weighted_sum(spark):
    df = spark.createDataFrame([(["love", "war", "love", "x"],)], "t array<string>")
    m = F.create_map(F.lit("love"), F.lit(10), F.lit("war"), F.lit(9))
    assert df.select(scoring.weighted_sum(F.col("t"), m).alias("s")).first().s == 29
    null_map = F.lit(None).cast("map<string,int>")
    assert df.select(scoring.weighted_sum(F.col("t"), null_map).alias("s")).first().s == 0


# --- the text rules, by Unicode category -------------------------------------------

# A sample of every plane: all of Latin, Greek and Cyrillic, punctuation and separators, then strides.
POINTS = [*range(0x20, 0x600), *range(0x1680, 0x16A0), *range(0x1FF0, 0x2070), 0x3000, 0x3042, 0xFEFF,
          *range(0x600, 0xD800, 97), *range(0xE000, 0x20000, 211)]


def assigned(ch):
    """Whether every Unicode version in use knows the character, and it is no surrogate."""
    return unicodedata.ucd_3_2_0.category(ch) not in ("Cn", "Cs")


def is_separator(ch):
    """White space by its Unicode properties: separators, and the controls of bidirectional class WS, B or S."""
    return unicodedata.category(ch) in ("Zs", "Zl", "Zp") or (
        unicodedata.category(ch) == "Cc" and unicodedata.bidirectional(ch) in ("WS", "B", "S"))


def test_word_rules_go_by_unicode_category(spark):
    # Letters whose lower case is not one letter are left to the vectors.
    chars = [c for c in map(chr, [*range(9, 14), *range(0x1C, 0x20), 0x85, *POINTS])
             if assigned(c) and len(c.lower()) == 1 and unicodedata.category(c) not in ("Lu", "Lt")]
    got = apply(spark, [f"xyz{c}uvw" for c in chars], text.title_score_tokens)
    for c, words in zip(chars, got):
        if unicodedata.category(c).startswith("L"):
            assert words == [f"xyz{c}uvw"], hex(ord(c))
        elif is_separator(c):
            assert words == ["xyz", "uvw"], hex(ord(c))
        else:
            assert words == [], hex(ord(c))


def test_genres_are_stripped_of_every_separator(spark):
    chars = [c for c in map(chr, [*range(9, 14), *range(0x1C, 0x20), 0x85, *POINTS])
             if assigned(c) and c != ","]
    got = apply(spark, [f"{c}ab{c}cd{c},{c}" for c in chars], text.genre_score_terms)
    for c, genres in zip(chars, got):
        kept = "" if is_separator(c) else c
        assert genres == [f"{kept}ab{c}cd{kept}", kept], hex(ord(c))


def test_word_vectors(spark):
    values = ["Ünder THE über straße", "it's wi-fi 3d ab1", "ΣΟΦΟΣ\u2003ΛΟΓΟΣ", "a\u0301b x\u00b2y", "one\x1ctwo\x85three",
              "zero\u200bwidth", "\u00aa ok fine"]
    assert apply(spark, values, text.clean_description) == [
        "ünder über straße", "", "σοφος λογος", "", "one two three", "", "fine"]
    assert apply(spark, ["\u00aa ok", "I am A"], text.title_score_tokens) == [["\u00aa", "ok"], []]


def test_year_parse_equals_python_int_on_ascii_text(spark):
    rng = random.Random(7)
    pieces = ["", " ", "\t", "　", "+", "-", "_", "0", "2", "9", "1", ".", "a", "20", "201"]
    values = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(400)]

    def py_int(v):
        try:
            return int(v)
        except ValueError:
            return None

    got = apply(spark, values, scoring.parse_year)
    assert got == [py_int(v) for v in values]


@pytest.mark.parametrize("name", ["description_tokens", "title_vocabulary_tokens", "title_score_tokens"])
def test_rules_by_name_equal_rules_by_column(spark, name):
    rule = getattr(text, name)
    df = one_col(spark, ["The Spider-Man of New York café", None])
    a = df.select(rule("v").alias("r")).collect()
    b = df.select(rule(F.col("v")).alias("r")).collect()
    assert a == b


def test_year_in_digits_of_any_script(spark):
    values = ["٢٠١٥", "२०१५", "2０15", " ٢_٠١٥ ", "𝟐𝟎𝟏𝟓", "²015", "٢٠١٥x", "Ⅻ"]

    def python(text):
        try:
            return int(text)
        except ValueError:
            return None
    assert apply(spark, values, scoring.parse_year) == [python(v) for v in values]
