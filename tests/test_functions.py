"""Scalar functions against plain Python and hand-built rows."""

import hashlib
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import langid, pii, scoring, tokenizer, toxicity
from corpusloom.functions import text as T


def one(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    return [tuple(r)[1:] for r in sorted(df.select("i", *exprs).collect(), key=lambda r: r[0])]


TEXTS = [None, "", "   ", "\x00\x07 \t\n", " N/A ", "Hello   World", "ｗｉｄｅ １２３４", "a　b c", "Ünï cödé 東京 9", "go " * 12, "x" * 5000, "line\r\nbreak\rhere"]


def normal(x):
    if x is None:
        return None
    x = re.sub(r"[\x00-\x1f\x7f-\x9f]", " ", unicodedata.normalize("NFKC", x))
    return re.sub(r"\s+", " ", x).strip() or None


def test_normalize(spark):
    assert [r[0] for r in one(spark, TEXTS, T.normalize_text("t"))] == [normal(x) for x in TEXTS]


def test_normalize_keeps_lines(spark):
    assert one(spark, ["a \r\n b\t c\n\n d", None, " \n "], T.normalize_text("t", keep_lines=True)) == [("a\nb c\n\nd",), (None,), (None,)]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), max_codepoint=0x3FF), max_size=60), min_size=1, max_size=15))
def test_metrics_against_python(spark, texts):
    got = one(spark, texts, T.quality_metrics("t").alias("q"), T.token_stats("t").alias("s"))
    for x, (q, s) in zip(texts, got):
        words = [w for w in re.split(f"[{re.escape(T.WHITE_CHARS)}]+", x) if w]
        assert q["n_chars"] == len(x) and q["n_words"] == len(words) == s["token_count"]
        assert s["unique_tokens"] == len(set(words))
        letters = sum(unicodedata.category(c)[0] == "L" for c in x)
        if all(unicodedata.category(c) != "Cn" for c in x):
            assert q["alpha_ratio"] == pytest.approx(letters / len(x) if x else 0)


def test_structural(spark):
    rows = ["<p>Hello <b>world</b></p>", "a < b and c > d", "keep this\nRead our Privacy Policy today\nand this", "we say Contact us now", "Wowwwww!!!!! yes....", "a    b     c", "&amp; <br/>x", None]
    want = ["Hello  world", "a   d", "keep this\nand this", "", "Wowww!! yes..", "a   b   c", "&amp;  x", None]
    assert [r[0] for r in one(spark, rows, T.structural_cleanup("t"))] == want


def test_masks(spark):
    rows = {
        "4111 1111 1111 1111": ((0, 1, 1, 0), "<PHONE> 1111"), "4111111111111111": ((0, 0, 1, 0), "<CREDIT_CARD>"), "4111-1111-1111-1111": ((0, 1, 1, 0), "<PHONE>-1111"),
        "12345678901234": ((0, 1, 1, 0), "<PHONE>"), "12345678901234567": ((0, 0, 0, 0), "12345678901234567"), "+1 415-555-0100": ((0, 1, 0, 0), "+<PHONE>"), "(415) 555-0100": ((0, 1, 0, 0), "(<PHONE>"),
        "2019-2020": ((0, 1, 0, 0), "<PHONE>"), "in 1999": ((0, 0, 0, 0), "in 1999"), "GB29NWBK60161331926819": ((0, 0, 0, 1), "<IBAN>"), "mail a.b@x.org": ((1, 0, 0, 0), "mail <EMAIL>"),
    }
    got = one(spark, list(rows), pii.detect_and_mask("t").alias("m"))
    for (x, (n, m)), (r,) in zip(rows.items(), got):
        assert (tuple(r[f"pii_{k}_hits"] for k in ("email", "phone", "cc", "iban")), r["text_pii_masked"], r["has_pii"]) == (n, m, any(n)), x
    (r,) = one(spark, [None], pii.detect_and_mask("t").alias("m"))[0]
    assert r["text_pii_masked"] is None and not r["has_pii"] and r["pii_cc_hits"] == 0


@pytest.mark.parametrize("text,spam", [("yes yes yes yes no", True), ("yes yes yes no", True), ("ok ok ok ok", True), ("yes no", False), ("a a a a a a a b b b", False), ("Yes yes YES yes", False), (None, False), ("", False)])
def test_spam(spark, text, spam):
    assert one(spark, [text], T.is_token_spam("t")) == [(spam,)]


def test_spam_guard_changes_nothing(spark):
    rows = ["a " * k + " ".join(f"w{i}" for i in range(m)) for k in range(0, 12) for m in range(0, 6)]
    got = one(spark, rows, T.is_token_spam("t"), (T.top_token_share("t") > 0.7) & (F.size(T.tokens("t")) >= 3))
    assert all(a == bool(b) for a, b in got)


def test_score(spark):
    rows = [(1.0, 20, 1.0, False, 1.0), (1.0, 20, 1.0, True, 0.9), (0.8, 10, 0.5, False, 0.67), (0.9, 0, 0.0, False, 0.46), (1.0, 2500, 0.4, False, 0.73), (1.0, 5000, 0.25, True, 0.45), (1.5, 1000, 2.0, False, 1.0), (1.0, 19, 0.5, True, 0.785), (float("nan"), 20, 1.0, False, 1.0), (None, None, None, None, 0.1)]
    df = spark.createDataFrame([r[:4] for r in rows], "l double, n int, u double, p boolean")
    got = [r[0] for r in df.select(scoring.quality_score("l", "n", "u", "p")).collect()]
    assert got == pytest.approx([r[4] for r in rows])


def test_doc_id(spark):
    df = spark.createDataFrame([("http://a", "hello"), (None, "hello")], "u string, t string")
    assert [r[0] for r in df.select(T.doc_id("u", "t")).collect()] == ["496b214646290e47a9f4cd207e57d15d7a624bc7", "0187ded702d1c253424fc072f915746d4e433a57"]


def test_canonical_and_hash(spark):
    got = one(spark, ["  Hello \n World ", None, ""], T.canonical("t"), T.sha256(T.canonical("t")), T.near_key("t", 3))
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got == [("hello world", h("hello world"), "hel"), ("", h(""), ""), ("", h(""), "")]


def test_fallbacks(spark):
    df = spark.createDataFrame([("", None, " x "), (" ", "b", "c"), (None, "", "")], "a string, b string, c string")
    assert [r[0] for r in df.select(T.first_filled("a", "b", "c")).collect()] == [" x ", " ", ""]
    assert [r[0] for r in df.select(T.first_filled("a", "b", "c", strip=True)).collect()] == ["x", "b", ""]


def test_toxicity_language_tokens(spark):
    t = one(spark, ["you idiot", "fine day", None], toxicity.toxicity("t").alias("x"))
    assert t[0][0]["insult"] == t[0][0]["toxicity"] == t[0][0]["severe_toxicity"] == 1.0 and t[1][0]["toxicity"] == 0 and t[2][0]["toxicity"] == 0
    lang = one(spark, ["the cat is on the mat", "der Hund ist nicht hier und das ist gut", "le chat est dans la rue", "el perro es muy bueno", "il cane non è della casa", "het huis is van de man en niet", "12 34", None], langid.lexical("t").alias("l"))
    assert [r[0]["lang"] for r in lang] == ["en", "de", "fr", "es", "it", "nl", "unk", "unk"]
    assert one(spark, ["aé", "", None], tokenizer.byte_level("t")) == [([97, 195, 169],), ([],), ([],)]


def test_bpe_ids_in_order(spark):
    """Ids that the public vocabulary is known to give."""
    want = {"hello world": [31373, 995], "Hello, world!": [15496, 11, 995, 0], "": [], " the": [262]}
    ids = tokenizer.bpe(spark, tokenizer.VOCABULARY)
    df = spark.createDataFrame([(t,) for t in want] + [(None,)], "t string").withColumn("ids", ids("t"))
    assert {r["t"]: r["ids"] for r in df.collect()} == {**want, None: []}
