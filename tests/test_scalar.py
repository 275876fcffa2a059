import math


from reelrank.functions import scalar


def java_hash(s: str) -> int:
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (31 * h + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_java_string_hash(spark):
    names = ["abc", "", "Customer#000000001", "zé", "a\U0001F600b", "x" * 40]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict(df.select("n", scalar.java_string_hash("n").alias("h")).collect())
    assert got["abc"] == 96354
    for n in names:
        assert got[n] == java_hash(n), n


def test_year_month_utc(spark):
    df = spark.createDataFrame([(1260759144,), (1262303999,), (1262304000,), (0,), (-1,)],
                               "t int")
    got = dict(df.select("t", scalar.year_month("t").alias("m")).collect())
    assert got[1260759144] == 200912
    assert got[1262303999] == 200912       # 2009-12-31 23:59:59 UTC
    assert got[1262304000] == 201001       # 2010-01-01 00:00:00 UTC
    assert got[0] == 197001 and got[-1] == 196912


def test_change_date_sql_function(spark):
    scalar.register_sql_functions(spark)
    assert spark.sql("SELECT changeDate(1260759144) AS m").first()["m"] == 200912


def test_strict_int_and_trim(spark):
    df = spark.createDataFrame([("5",), (" 5",), ("+7",), ("-3",), ("x",), ("99999999999",)],
                               "s string")
    got = dict(df.select("s", scalar.strict_int("s").alias("v")).collect())
    assert got == {"5": 5, " 5": None, "+7": 7, "-3": -3, "x": None, "99999999999": None}
    t = spark.createDataFrame([("\t a b \n",)], "s string")
    assert t.select(scalar.java_trim("s")).first()[0] == "a b"


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame(
        [(1, [(22, 4.5), (45, 3.8)]), (2, [])],
        "uid int, recs array<struct<rid:int,r:double>>")
    enc = df.select("uid", scalar.encode_recs("recs").alias("s"))
    assert dict(enc.collect()) == {1: "22:4.5|45:3.8", 2: ""}
    dec = enc.select("uid", scalar.decode_recs("s").alias("recs"))
    back = {r["uid"]: [tuple(x) for x in r["recs"]] for r in dec.collect()}
    assert back == {1: [(22, 4.5), (45, 3.8)], 2: []}


def test_recent_item_decode(spark):
    df = spark.createDataFrame([(" 12 | 4.5 ",), ("7|x",)], "s string")
    got = [tuple(r[0]) for r in df.select(scalar.decode_recent_item("s")).collect()]
    assert got == [(12, 4.5), (7, None)]


def test_log2_count_missing_is_one(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (8,), (None,)], "n int")
    got = [r[0] for r in df.select(scalar.log2_count("n")).collect()]
    assert got == [0.0, 0.0, 1.0, 3.0, 0.0]


def test_cosine_edges(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0]), ([1.0, 0.0], [0.0, 3.0]),
         ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(scalar.cosine("a", "b")).collect()]
    assert math.isclose(got[0], 1.0) and math.isclose(got[1], -1.0)
    assert got[2] == 0.0 and got[3] is None           # zero vector -> NULL (D9)
