"""Property checks: native Spark expressions against brute-force Python
re-statements of the same rules on generated inputs (one Spark job per batch),
plus the SURVEY section 5 invariants."""

import re
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankflow.functions import numbers as N
from rankflow.functions import text as X
from rankflow.operators import relational as R
from rankflow.plans import jobs as J

SETTINGS = settings(max_examples=8, deadline=None)


def py_unit_number(text, units, remove, null_as):
    if text is None:
        return null_as
    s = text
    for ch in remove:
        s = s.replace(ch, "")
    m = re.search(r"[0-9]+(\.[0-9]+)?", s)
    if not m:
        return None
    v = Decimal(m.group())
    for u in units:
        if u in s:
            v *= N.UNIT_FACTORS[u]
    return int(v)


def py_keywords(name):
    if name is None:
        return None
    keep = [t for t in name.split(" ")
            if (re.search(X.HANGUL, t) or re.search(X.LATIN_WORD, t)) and not re.search(X.LETTER_DIGIT_MIX, t)]
    stripped = [t.replace("|", "").strip(" ") for t in keep]
    stripped = [t for t in stripped if t.strip(" ") != ""]
    parts = [p.strip(" ") for t in stripped for p in re.split(X.SYMBOL_SPLIT, t)]
    return [p for p in parts if p.strip(" ") != ""]


unit_text = st.one_of(st.none(), st.text(alphabet="0123456789., 천만백회a", max_size=12))
names = st.text(alphabet="ab Z9-|[]가나 .", max_size=20)


@SETTINGS
@given(st.lists(unit_text, min_size=1, max_size=40))
def test_unit_number_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for units, remove, null_as in ((N.DETAIL_UNITS, (",", " "), None), (N.RANKING_UNITS, (" ",), 0)):
        got = [r[0] for r in df.select(N.parse_unit_number("t", units, remove, null_as)).collect()]
        assert got == [py_unit_number(t, units, remove, null_as) for t in texts]


@SETTINGS
@given(st.lists(names, min_size=1, max_size=40))
def test_product_keywords_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.product_keywords("t")).collect()]
    assert got == [py_keywords(t) for t in texts]


@SETTINGS
@given(st.lists(st.floats(min_value=0, max_value=3, allow_nan=False), min_size=1, max_size=50))
def test_cap_output_never_above_one_when_a_value_is_below(spark, rates):
    df = spark.createDataFrame([(float(r),) for r in rates], "conversionRate double")
    out = [r[0] for r in J.cap_rate(df).collect()]
    if any(r < 1 for r in rates):
        assert all(o is not None and o <= 1 for o in out)
    assert [o for o, r in zip(out, rates) if r <= 1] == [r for r in rates if r <= 1]


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c"]), min_size=1, max_size=60))
def test_union_count_is_sum_of_counts(spark, cats):
    df = spark.createDataFrame([(c, i) for i, c in enumerate(cats)], "category string, id long")
    parts = [R.for_category(df, c) for c in ("a", "b", "c")]
    assert R.union_all(parts).count() == sum(p.count() for p in parts) == len(cats)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 1000)), min_size=1, max_size=60))
def test_latest_forms_agree(spark, rows):
    from rankflow.operators import windows as W

    df = spark.createDataFrame(rows, "k long, ts long, id long")
    a = sorted(W.latest_per_key(df, ["k"], "ts", ["id"]).collect())
    b = sorted(W.latest_by_max(df, ["k"], "ts", ["id"]).select("k", "ts", "id").collect())
    assert a == b and len(a) == len({r[0] for r in rows})


def test_colours_match_python(spark):
    rows = ["Navy 블랙 knit", "plain", "BLUE-green white", None, "그레이차콜"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in df.select(X.extract_colors("t")).collect()]
    want = []
    for r in rows:
        found = [c for c in X.COLORS if r is not None and c in r.lower()]
        want.append(" | ".join(found) if found else None)
    assert got == want
    assert spark.range(1).select(F.lit(1)).count() == 1
