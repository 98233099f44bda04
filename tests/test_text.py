import string
import sys

import pytest
from pyspark.sql import functions as F

from quillmill.functions import text as X
from quillmill.sources import readers

BLANKS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def test_linebreaks_are_replaced_in_one_pass(values):
    got = values(X.replace_linebreaks, ["a\n\n\nb", "a  b   c    d", "a\r\nb", "a\n\nb", "", None])
    assert got == ["a <p> <p> b", "a b  c  d", "a <p> b", "a <p> b", "", None]


def test_linebreaks_match_literal_replacement(values):
    texts = ["\n", "\n\n", " \n \n ", "x\r\n\r\n\r\ny  z", "<p>  <p>  <p>", "\n" * 7]

    def literal(t):
        t = t.replace("\r", "").replace("\n", " <p> ")
        return t.replace("<p>  <p>", "<p>").replace("  ", " ")

    assert values(X.replace_linebreaks, texts) == [literal(t) for t in texts]


def test_transliteration(values):
    got = values(
        X.decode_unicode,
        ["plain", "Straße — “Zoë”", "ÀÉÎÕÜ çñ Œuvre Łódź", "Ελλάδα", "Щука Юг", "5 € … ½ ⅓ ﬁ Ａ① Ⅳ ²", "汉x字", "á", None, ""],
    )
    assert got == ["plain", 'Strasse -- "Zoe"', "AEIOU cn OEuvre Lodz", "Ellada", "Shchuka Iug", "5 EUR ... 1/2 1/3 fi A1 IV 2", "x", "a", None, ""]


def test_transliteration_is_ascii_for_all_table_letters(values):
    letters = "".join(X._SPELLINGS)
    assert values(X.decode_unicode, [letters])[0] == "".join(X._SPELLINGS[c] for c in letters)
    assert all(v.isascii() for v in X._SPELLINGS.values())


def test_transliteration_of_latin_letters_is_complete(values):
    latin = [chr(c) for c in range(0xC0, 0x180)]
    assert all(v and v.isascii() for v in values(X.decode_unicode, latin))


def test_transliterate_record_leaves_other_types(spark):
    df = spark.createDataFrame([("é", 1, ["é"])], "a string, b int, c array<string>")
    assert tuple(X.decode_unicode_record(df).first()) == ("e", 1, ["é"])


def test_token_count_matches_split(values):
    texts = ["", " ", "one", " a b\tc\nd "] + [f"x{b}y{b}{b}z" for b in BLANKS] + ["a​b", "日本 語"]
    assert values(X.token_count, texts) == [len(t.split()) for t in texts]


def test_strip_matches_python(values):
    texts = [f"{b} a {b} b{b}" for b in BLANKS] + ["", "\n\n", "x\n"]
    assert values(X.strip, texts) == [t.strip() for t in texts]


def test_words_lose_ascii_punctuation(values):
    assert X.ASCII_PUNCTUATION == string.punctuation
    assert values(X.tokens_no_punct, ["Austin, TX. (U.S.) --- é!"]) == [["Austin", "TX", "US", "", "é"]]


def test_drop_lines(values):
    text = "  a \n\n \t\nWe use cookies to improve your visit\n b "
    assert values(lambda c: X.drop_lines(c, "We use cookies to improve your"), [text]) == ["a\nb"]
    assert values(X.drop_lines, ["\n \n"]) == [""]


def test_distinct_join_keeps_first_seen_order(spark):
    df = spark.createDataFrame([(["b", "", "a", "b", "c", "a"],)], "a array<string>")
    assert df.select(X.distinct_join(F.col("a"))).first()[0] == "b,a,c"


def test_split_tags_is_literal(values):
    assert values(lambda c: X.split_tags(c, ","), ["a, b,c"]) == [["a", " b", "c"]]
    assert values(lambda c: X.split_tags(c, ", "), ["a, b,c"]) == [["a", "b,c"]]
    assert values(lambda c: X.split_tags(c, "."), ["a.b"]) == [["a", "b"]]


def test_ids_are_padded_but_never_cut(spark):
    df = spark.createDataFrame([(7, "sun", "u"), (1234567, "sun", "u")], "n int, s string, u string")
    n, s, u = F.col("n"), F.col("s"), F.col("u")
    got = df.select(X.doc_id(n, s), X.doc_id(n, s, u), X.record_file_name(n, s)).collect()
    assert tuple(got[0]) == ("00007_sun", "00007_sun_u", "00007_sun.json")
    assert tuple(got[1]) == ("1234567_sun", "1234567_sun_u", "1234567_sun.json")


def test_batch_file_name(spark):
    df = spark.createDataFrame([("2020-03-20_corona_tweets_02.csv", 3), ("short", 123)], "n string, b int")
    got = [r[0] for r in df.select(X.batch_file_name(F.col("n"), F.col("b"), "json")).collect()]
    assert got == ["2020-03-20__03.json", "short_123.json"]


def test_corpus_line_keeps_tab_for_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "i int, t string")
    assert [r[0] for r in df.select(X.corpus_line(F.col("i"), F.col("t"))).collect()] == ["1\t", "2\tx"]


def test_transliteration_of_more_scripts(values):
    texts = {
        "שלום": "SHlvm", "العربية": "l`rby@", "नमस्ते": "nmste", "ไทย": "aithy", "თბილისი": "t`bilisi", "Հայ": "Hay",
        "کتاب؟": "ktb?", "१२३ ٣ ๔": "123 3 4", "₽₹₩": "RRsW", "தமிழ்": "tmilll", "汉ᚠ": "",
    }
    assert values(X.decode_unicode, list(texts)) == list(texts.values())


def test_spellings_may_be_added_and_losses_are_counted(values):
    readings = {"汉": "Han ", "ß": "sz", "a": "no ASCII letter is changed"}
    texts = ["汉a ß", "字ᚠᚠ é́", "plain", "한국", "\U000f0000\U000f0001x", "", None]
    assert values(lambda c: X.decode_unicode(c, readings), texts) == ["Han a sz", " e", "plain", "hangug", "x", "", None]
    assert values(lambda c: X.lost_characters(c, readings), texts) == [0, 3, 0, 0, 2, 0, None]


def test_few_and_many_letters_are_spelt_alike(values):
    many = "".join(X._SPELLINGS) + "한국\U000f0000汉 end"
    singles = values(X.decode_unicode, list(many))
    assert values(X.decode_unicode, [many])[0] == "".join(singles)


def test_spelling_table(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("# letters\n6c49\tHan \n5B57\tZi\n16A0\t\"\n1f600\n")
    assert readers.read_spellings(spark, str(tmp_path / "t.tsv")) == {"汉": "Han ", "字": "Zi", "ᚠ": '"', "😀": ""}
    with pytest.raises(ValueError, match="more than 2"):
        readers.read_spellings(spark, str(tmp_path / "t.tsv"), most=2)
