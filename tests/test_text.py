import json
import re
import unicodedata

from pyspark.sql import functions as F

from sparkmill.functions import text as X, textnorm as N


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first()[0]


def many(spark, values, column):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", column(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


def test_letters_and_digits_are_what_the_pattern_keeps():
    wrong = [c for c in range(0x110000) if bool(re.match(r"[^\W_]", chr(c))) != (unicodedata.category(chr(c))[0] in "LN")]
    assert not wrong


def test_norm_is_the_same_on_either_side(spark):
    texts = ["Ａ＿０２ 굴젠", "레 닐 다!!", "ﬁ ½ ① Ⅳ", "한글", "İ Σς", "a​b", "", None, "_", "가\n나\t다", "x" * 5000]
    assert many(spark, texts, N.norm) == [N.py_norm(t) for t in texts]


def test_family_key(spark):
    assert many(spark, [" A_01은  E_02를 공격해 !", "A_03 , E_04 쪽", "BA_01 그대로", None, ""], X.family_key) == ["A_ID{JOSA_ST} E_ID{JOSA_OBJ} 공격해!", "A_ID, E_ID 쪽", "BA_01 그대로", None, ""]
    odd = ["A_01 은 가", "A_01은; 가", "A_01은행 가", "E_ID을 A_ID  이 , .", "부대A_01이 가", "A_01,A_02,E_03를", "A_012 A_1 _A_01", "AE_01 A_01 ,, ! 끝  ?", ", , ."]
    assert many(spark, odd, X.family_key) == [
        "A_ID{JOSA_ST} 가", "A_ID{JOSA_ST}; 가", "A_ID은행 가", "E_ID{JOSA_OBJ} A_ID{JOSA_ST},.", "부대A_ID{JOSA_ST} 가", "A_ID, A_ID, E_ID{JOSA_OBJ}", "A_012 A_1 _A_01", "AE_01 A_ID, ,! 끝?", ", ,.",
    ]


def test_comments_keep_slot_separators(spark):
    assert many(spark, ["# all", "train a.b#1.3  # note", "train a.b#1.3", ""], X.without_comment) == ["", "train a.b#1.3", "train a.b#1.3", ""]


def test_split_count(spark):
    rows = many(spark, ["a.b.3", "a.b", "a.12x", None], X.split_count)
    assert [(r["prefix"], r["count"]) for r in rows] == [("a.b", 3), (None, None), (None, None), (None, None)]


def test_first_json(spark):
    got = many(spark, ['x {"a": "}\\"{"} y {}', "[1, [2]] tail", "none", "", None, '{"a": [1}', '{"a": [1]'], X.first_json)
    assert got == ['{"a": "}\\"{"}', "[1, [2]]", None, None, None, None, None]  # what begins at the first bracket must be whole
    assert X.found_json("[" * 100_000) is None


def test_canonical_json_keeps_number_text_and_drops_keys(spark):
    got = many(spark, ['{"b": 2.0, "id": 1, "a": [{"id": 3, "c": 2}]}', "no", None], lambda c: X.canonical_json(c, "id"))
    assert got == ['{"a":[{"c":2}],"b":2.0}', None, None]


def test_key_paths(spark):
    assert one(spark, '{"a": {"x": 1, "l": [{"x": 2}]}}', lambda c: X.key_paths(c, ["x"])) == ["$.a.x", "$.a.l[0].x"]


def test_strict_variant_refuses_trailing_text(spark):
    got = many(spark, ['{"a":1}', '{"a":1}\n{"a":2}', "1,2", "NaN", "", None], lambda c: F.to_json(X.strict_variant(c)))
    assert got == ['{"a":1}', None, None, None, None, None]


def test_small_scalars(spark):
    assert many(spark, ["a, b ,", "{}", "", None], X.listed) == [["a", "b"], [], [], []]
    assert many(spark, ["abcdef", "abc"], lambda c: X.truncated(c, 4)) == ["abc…", "abc"]
    assert many(spark, ['"a\\"b"', '"x', "y"], X.unquoted) == ['a"b', '"x', "y"]
    assert many(spark, ["3", "3.0", "3.5", "true", None], X.lenient_int) == [3, 3, None, None, None]
    assert json.loads(one(spark, '```json\n{"a": 1}\n```', X.without_fence)) == {"a": 1}
