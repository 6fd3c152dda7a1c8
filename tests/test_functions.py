from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from adflow.functions import collections as arrays
from adflow.functions import numbers, records
from adflow.functions import text as texts
from adflow.functions.sizes import size_decode, size_encode

# Sizes and their codes.
SIZES = """\
960*60 257698038720, 300*100 429496729900, 360*90 386547057000, 320*48 206158430528, 120*270 1159641170040,
360*300 1288490189160, 360*50 214748365160, 336*280 1202590843216, 960*90 386547057600, 640*80 343597384320,
320*50 214748365120, 728*90 386547057368, 160*80 343597383840, 640*90 386547057280, 760*90 386547057400,
1000*90 386547057640, 400*300 1288490189200, 672*120 515396076192, 180*150 644245094580, 120*600 2576980377720,
200*60 257698037960, 580*90 386547057220, 500*200 858993459700, 125*125 536870912125, 360*108 463856468328,
320*80 343597384000, 640*60 257698038400, 480*160 687194767840, 160*600 2576980377760, 264*160 687194767624,
256*58 249108103424, 300*250 1073741824300, 468*60 257698038228, 250*250 1073741824250, 460*60 257698038220,
300*50 214748365100, 120*240 1030792151160, 240*180 773094113520, 200*200 858993459400"""


def one(spark, *columns):
    """Values of columns over a table of one row."""
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def strings(*values):
    return F.array(*[F.lit(v) for v in values])


def test_sizes(spark):
    pairs = [pair.split() for pair in SIZES.replace("\n", " ").split(",")]
    df = spark.createDataFrame([(s, int(c)) for s, c in pairs], "size string, code bigint")
    assert df.count() == 39
    got = df.select("*", size_encode(F.col("size")).alias("e"), size_decode(F.col("code")).alias("d")).collect()
    assert all(r["e"] == r["code"] and r["d"] == r["size"] for r in got)


def test_malformed_sizes(spark):
    texts_in = ["0", "", "300", "x*2", "2*x", "*60", "60*", " 960*60", "1*1"]
    df = spark.createDataFrame([(t,) for t in [*texts_in, None]], "s string")
    got = [r["c"] for r in df.select(size_encode(F.col("s")).alias("c")).collect()]
    assert got == [0] * 8 + [2**32 + 1, 0]
    assert one(spark, size_decode(F.lit(0).cast("bigint")), size_decode(F.lit(2147483648600))) == ("", "600*500")


def test_text(spark):
    got = one(
        spark,
        texts.initials(F.lit("michael bevilacqua linn")),
        texts.prefix_text(F.lit("jack")),
        F.array_join(texts.vowels_in_word(F.lit("ajok")), ""),
        F.size(texts.vowels_in_word(F.lit("mklw"))),
        texts.append_chain(F.lit("1"), "abc", compose=True),
        texts.append_chain(F.lit("1"), "abc"),
        texts.reverse_text(F.lit("abc")),
        texts.full_name(F.lit("Mike"), F.lit("Linn")),
        texts.full_address(F.lit(123), F.lit("No. #3")),
        texts.concat_key(F.lit("58.com"), F.lit(5)),
    )
    assert got == (
        "MBL", "Hello, jack", "ao", 0, "1cba", "1abc", "cba", "Mike Linn", "123 No. #3", "58.com_5",
    )


def test_text_length(spark):
    mail = F.lit("hello, my friend")
    checks = [texts.minimum_size(mail, 20), texts.minimum_size(mail, 1), texts.maximum_size(mail, 16)]
    assert one(spark, *checks, texts.length_check(mail, "==", 16), texts.length_check(mail, "<", 16)) == (
        False, True, True, True, False,
    )


@pytest.mark.parametrize(
    "line, expected",
    [("a b", ["a", "b"]), ("a  b  ", ["a", "", "b"]), ("", [""]), ("   ", []), (" a", ["", "a"])],
)
def test_words_drop_trailing_blanks(spark, line, expected):
    assert one(spark, texts.words(F.lit(line)))[0] == expected


def test_numbers(spark):
    got = one(
        spark,
        numbers.percent_discount(F.lit(200.0), 50),
        numbers.percent_discount(F.lit(200.0), F.lit(25.0)),
        numbers.state_tax(F.lit(100.0), F.lit("NY")),
        numbers.state_tax(F.lit(100.0), F.lit("PA")),
        numbers.int_divide(F.lit(-7), F.lit(2)),
        numbers.factorial(F.lit(10)),
        numbers.is_even(F.lit(0)),
        numbers.rate(F.lit(39), F.lit(0)),
        numbers.rate(F.lit(10689), F.lit(131324)),
    )
    assert got[:2] == (100.0, 150.0)
    assert got[2:4] == pytest.approx((6.45, 4.5))
    assert got[4:] == (-3, 3628800, True, 0, 81)


def test_numbers_out_of_their_domain(spark):
    with pytest.raises(ValueError):
        numbers.percent_discount(F.lit(1.0), 101)
    for bad in (
        numbers.percent_discount(F.lit(1.0), F.lit(-1.0)),
        numbers.state_tax(F.lit(100.0), F.lit("MATCHERROR")),
        numbers.int_divide(F.lit(1), F.lit(0)),
    ):
        with pytest.raises(Exception, match="Discounts|no tax rate|DIVIDE_BY_ZERO"):
            one(spark, bad)


def test_grades(spark):
    grades = [5.0, 4.0, 4.4, 2.2, 3.3, 3.5, 0.0, 0.1, 5.1, -1.0]
    df = spark.createDataFrame([(g,) for g in grades], "g double")
    fine = numbers.grade_letter(F.col("g"), numbers.PLUS_MINUS_GRADES)
    got = df.select(numbers.grade_letter(F.col("g")).alias("full"), fine.alias("fine")).collect()
    assert [r["full"] for r in got] == ["A", "B", "A", "C", "B", "B", "F", "D", "N/A", "N/A"]
    assert [r["fine"] for r in got] == ["A", "B", "A-", "D", "C+", "B-", "F", "D", "N/A", "N/A"]


def test_shapes(spark):
    rows = [("circle", 4.0, 0.0), ("rectangle", 2.0, 2.0), ("square", 4.0, 0.0)]
    df = spark.createDataFrame(rows, "kind string, a double, b double")
    sides = F.col("kind"), F.col("a"), F.col("b")
    got = df.select(numbers.perimeter(*sides).alias("p"), numbers.area(*sides).alias("a")).collect()
    assert [tuple(r) for r in got] == [(8 * math.pi, 16 * math.pi), (8.0, 4.0), (16.0, 16.0)]


def test_draws_are_even_and_reproducible(spark):
    ids = spark.range(100_000)
    got = ids.select(numbers.draw_below(F.col("id"), 1, 10).alias("d")).groupBy("d").count().collect()
    assert len(got) == 10 and all(abs(r["count"] - 10_000) < 500 for r in got)
    pair = ids.select(F.corr(numbers.draw_unit(F.col("id"), 1), numbers.draw_unit(F.col("id"), 2))).first()[0]
    assert abs(pair) < 0.02
    bounds = ids.select(F.min(numbers.draw(F.col("id"), 3)), F.max(numbers.draw(F.col("id"), 3))).first()
    assert 0 <= bounds[0] and bounds[1] < 2**31


def test_arrays(spark):
    numbers_in = F.array(*[F.lit(i).cast("bigint") for i in range(1, 11)])
    got = one(
        spark,
        arrays.even_times(F.sequence(F.lit(1), F.lit(5)), 2),
        arrays.next_codes(F.lit("12345")),
        arrays.array_head(strings("apples", "oranges", "pears")),
        arrays.array_tail(strings("apples", "oranges", "pears")),
        arrays.array_is_empty(F.array()),
        arrays.array_sum(numbers_in),
        arrays.add_to_all(F.array(F.lit(42)), F.array(F.lit(8))),
        arrays.sort_distinct_array(F.array(*[F.lit(i) for i in (5, 7, 2, 7, 0)])),
        F.array_remove(F.array(*[F.lit(i) for i in (1, 2, 6, 3, 4, 5, 6)]), 6),
    )
    assert got == (
        [4, 8], [50, 51, 52, 53, 54], "apples", ["oranges", "pears"], True, 55, [50], [0, 2, 5, 7], [1, 2, 3, 4, 5],
    )
    four = F.array(*[F.lit(i) for i in (1, 2, 3, 4)])
    even = lambda x: x % 2 == 0
    parts = one(spark, arrays.array_partition(four, even))[0]
    assert (parts["yes"], parts["no"]) == ([2, 4], [1, 3])
    assert one(
        spark, arrays.array_concat(strings("a"), strings("b")), arrays.array_drop(four, 3), arrays.array_drop(four, 9),
        arrays.array_find(four, lambda x: x > 2), arrays.array_find(four, lambda x: x > 9),
    ) == (["a", "b"], [4], [], 3, None)
    zipped = one(spark, arrays.zip_short(F.array(F.lit(1), F.lit(2), F.lit(3)), strings("a", "b")))[0]
    assert [tuple(z) for z in zipped] == [(1, "a"), (2, "b")]
    assert one(spark, arrays.array_tail(F.array().cast("array<int>")), arrays.array_head(F.array())) == ([], None)


def test_maps_and_paths(spark):
    phones = F.create_map(*[F.lit(x) for x in ("steve", 100, "bob", 101, "joe", 201)])
    m = F.create_map(*[F.lit(x) for x in (1, 100, 2, 200)])
    assert one(
        spark, arrays.keep_values_below(phones, 200), arrays.keep_keys_above(m, 1), arrays.scale_keys(m, 10), F.map_values(m)
    ) == ({"steve": 100, "bob": 101}, {2: 200}, {10: 100, 20: 200}, [100, 200])
    person = F.lit('{"name": {"first": "Michael", "last": "Linn"}, "a.b": 1}')
    nested = F.create_map(F.lit("name"), F.create_map(F.lit("first"), F.lit("Michael")))
    assert one(
        spark,
        arrays.path_select(person, "name", "first"),
        arrays.path_select(person, "name", "middle"),
        arrays.path_select(person, "a.b"),
        arrays.path_select_map(nested, "name", "first"),
        arrays.path_select_map(nested, "nickname", "first"),
    ) == ("Michael", None, "1", "Michael", None)
    for select in (arrays.path_select, arrays.path_select_map):
        with pytest.raises(ValueError):
            select(person)


def test_codes(spark):
    codes = [F.lit(i) for i in (1, 0, 7)]
    assert one(spark, *[records.code_to_literal(c, records.CHANNELS) for c in codes]) == ("NOVA", "3rd-DSP", "-")
    assert one(spark, records.code_to_literal(F.lit(4), records.RESOURCE_TYPES)) == ("PC贴片",)
    assert one(spark, records.code_to_literal(F.lit(2), records.TRAFFIC_TYPES)) == ("APP",)


def test_cases(spark):
    rows = [("eight", 8), ("four", 4), ("two", 2), ("six", 6)]
    df = spark.createDataFrame(rows, "word string, freq int")
    word, freq = F.col("word"), F.col("freq")
    got = [r[0] for r in df.select(records.case_or_default(word, freq)).collect()]
    assert got == ["eight", "four", "not valid", "six"]
    with pytest.raises(Exception, match=r"no case for \(two,2\)"):
        df.select(records.strict_case(word, freq)).collect()
    choices = [records.choose_by_number(F.lit(n), F.lit("a"), F.lit("b"), F.lit("c")) for n in (1, 2, 3, 4)]
    assert one(spark, *choices) == ("a", "b", "c", None)


def test_typed_case(spark):
    schema = "n int, t string, email struct<subject: string>"
    rows = [(1, None, None), (None, "two", None), (None, "test", None), (2, None, None), (None, None, ("title here",))]
    df = spark.createDataFrame(rows, schema)
    got = df.select(records.typed_case(F.col("n"), F.col("t"), F.col("email"))).collect()
    assert [r[0] for r in got] == ["one", "2", "many", "scala.Int", "Email: subject = title here"]


def test_defaults_and_updates(spark):
    default = {"first": "John", "last": "Doe"}
    full = records.default_if_any_null(default, first=F.lit("Mike"), last=F.lit("Linn"))
    part = records.default_if_any_null(default, first=F.lit("Mike"), last=F.lit(None).cast("string"))
    mail = F.struct(F.lit("subject").alias("subject"), F.lit("").alias("text"))
    changed = records.struct_update(mail, subject=F.lit("haha"), text=F.lit("hello"))
    got = one(spark, full, part, changed)
    assert [tuple(r) for r in got] == [("Mike", "Linn"), ("John", "Doe"), ("haha", "hello")]


def test_partner_hash(spark):
    def encoded(partner, user, salt):
        return records.partner_hash(F.lit(user), F.lit(partner), F.lit(salt).cast("string"))

    got = one(spark, encoded("Acxiom", 1, "nnnnn"), encoded("Bluekai", 2, "mmmmm"), encoded("Dummy", 3, "s"))
    assert got == ("1ll", "mmmmm2kk", "3_sjj")
    assert one(spark, encoded("Acxiom", 12, None), records.hash_table_name(F.lit("Acxiom"))) == (
        "12ll", "Ingest_Hash_Table_Acxiom",
    )
    for partner, message in (("Dummy", "no salt for Dummy"), ("Nobody", "unknown partner Nobody")):
        with pytest.raises(Exception, match=message):
            one(spark, encoded(partner, 1, None))
