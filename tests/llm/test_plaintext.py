import unicodedata

import pytest
import regex
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tests.duck import ROOT
from voxsieve.llm import plaintext as pt
from voxsieve.llm.queries import _texts

LOOK, LOOSE = {}, {}


@pytest.fixture(autouse=True)
def known(spark):
    for table, found in zip((LOOK, LOOSE), pt.look_alikes(spark), strict=True):
        table.update(found)


GONE = regex.compile("[\\p{Cf}͏ᅟᅠ឴឵᠋-᠏ㅤ︀-️ﾠ\U000e0100-\U000e01ef]|[\\p{Cc}--[\\t-\\r\\x1c-\\x1f\\x85]]", regex.V1)


def brute(text):
    """The plain form by Python's own Unicode functions, word by word."""
    text = GONE.sub("", text)
    text = "".join(" " if c in pt.BLANKS else c for c in text)
    first = lambda c: LOOK.get(c) if len(unicodedata.normalize("NFKD", c)) == 1 else None
    raw = regex.findall(r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+[\p{M}\uFF9E\uFF9F]*", text)
    words = [unicodedata.normalize("NFKD", w) for w in raw]

    def counts(w):
        k = dict.fromkeys("lswo", 0)
        for c in "".join(c if first(c) else unicodedata.normalize("NFKD", c) for c in w):
            script = unicodedata.name(c, "").split(" ")[0]
            if unicodedata.category(c)[0] == "L" and script in pt.SCRIPTS:
                k["s" if c in LOOK else "w" if c in LOOSE else "l" if script == "LATIN" else "o"] += 1
        return k

    def mixed(k):
        return (k["o"] + k["w"] == 0 and k["s"] and k["l"]) or (k["o"] == 0 and k["w"] and k["l"] > k["w"] + k["s"])

    ks = [counts(w) for w in raw]
    foreign = any(k["o"] + k["w"] and not mixed(k) for k in ks)
    out = ""
    for w, k, r in zip(words, ks, raw):
        if mixed(k) or (k["s"] and not k["l"] + k["o"] + k["w"] and not foreign):
            w = "".join(LOOK.get(c) or LOOSE.get(c) or c for c in unicodedata.normalize("NFKD", "".join(first(c) or c for c in r)))
        out += unicodedata.normalize("NFC", w)
    return out


def plain(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.plain for r in pt.changed_rows(df, "text").collect()}
    return [got.get(i, t) for i, t in enumerate(texts)]


def test_all_texts_of_the_tables(spark):
    rows = _texts(spark, f"{ROOT}/sf0.1").where("text is not null")
    got = {(r.table_name, r.row_id): r.plain for r in pt.changed_rows(rows, "text").collect()}
    want = {(r.table_name, r.row_id): b for r in rows.collect() if (b := brute(r.text)) != r.text}
    assert got == want and len(got) > 1000


def test_examples(spark):
    pairs = {
        "Ｈｅｌｌｏ　ｙｏｕ！": "Hello you!", "café": "café", "ze​ro wi­dth": "zero width", "a b c": "a b c", "аurеlо": "aurelo", "уо": "yo", "включи свет": "включи свет", "уо свет": "уо свет", "ﬁn ½": "fin 1⁄2", "⼀⼈": "一人", "": "", "plain": "plain",
        "й́ й": "й́ й", "ё": "ë", "한": "한", "ấ": "ấ", "ệ": "ệ", "ệ": "ệ", "\t\n": "  ", "​": "", "δυνάμωσε τη": "δυνάμωσε τη", "hellο τη": "hello τη", "ɡο": "go", "ä́": "ä́", "≮": "≮", "\U0001d400": "A", "ｶﾞ": "ガ", "שלום": "שלום",
    }
    assert dict(zip(pairs, plain(spark, list(pairs)))) == pairs


def test_look_alikes_of_public_data(spark):
    pairs = {"he\u04cf\u04cfo": "heiio", "\u13aell": "Pll", "\u13bbello": "Hello", "\ua4d0lue": "Blue", "\u2c98oon": "Moon", "\u01c0ike": "Iike", "\u03f2at": "cat", "\u0417\u0430\u0437\u043e\u0440": "\u0417\u0430\u0437\u043e\u0440", "\u057d\u0561\u0580": "\u057d\u0561\u0580"}
    got = dict(zip(pairs, plain(spark, list(pairs))))
    assert {k: v for k, v in got.items() if v != pairs[k]} == {}


def test_long_words_are_judged_whole(spark):
    word = "x" * 600 + "\u0435"  # the look-alike lies in the second piece, all Latin letters in the first
    jamo = "\u1112\u1161\u11ab" * 700
    marks = "a" * 511 + "e\u0301" + "o\u0323\u0302" * 400
    foreign = "\u0435" * 600 + "\u0449"
    assert plain(spark, [word, jamo, marks, foreign]) == ["x" * 600 + "e", "\ud55c" * 700, "a" * 511 + "\u00e9" + "\u1ed9" * 400, foreign]


def test_nulls_long_texts_repeats_and_other_columns(spark):
    long = "Ｈеllо wоrld " * 20_000
    df = spark.createDataFrame([(1, long, "p"), (2, long, "p"), (3, None, "p"), (4, "x" * 5000 + "е", "p"), (5, "́" * 3000, "p")], "id int, text string, plain string")
    got = {r.id: r.plain for r in pt.changed_rows(df, "text").collect()}
    assert got[1] == got[2] == "Hello world " * 20_000 and set(got) - {4} == {1, 2} and got.get(4, "").count("x") in (0, 5000)
    assert pt.changed_rows(df.limit(0), "text").count() == 0


@settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.one_of(st.sampled_from("aeо е̧̣́각가각ｶﾞﬁ½①​ ęệΩ☺"), st.characters(exclude_categories=["Cs", "Cn", "Co"]).filter(lambda c: unicodedata.ucd_3_2_0.category(c) != "Cn")), max_size=12), min_size=150, max_size=250))
def test_equals_brute_force_on_random_texts(spark, texts):
    got = plain(spark, texts)
    for t, g in zip(texts, got):
        assert g == brute(t), [hex(ord(c)) for c in t]


def test_hot_texts_are_salted(spark, monkeypatch):
    """With every text taken as hot the result is the same."""
    rows = _texts(spark, f"{ROOT}/sf0.001")
    want = sorted(map(tuple, pt.changed_rows(rows, "text").collect()))
    monkeypatch.setattr("voxsieve.operators.skew.heavy_keys", lambda df, key, **_: [r[0] for r in df.select(key).distinct().collect()])
    assert sorted(map(tuple, pt.changed_rows(rows, "text").collect())) == want and want
