from reelrank.functions.scalar import java_string_hash
from reelrank.operators import users

from conftest import rows


def test_users_merge(spark):
    existing = spark.createDataFrame([(java_hash("ann"), "ann", [], False)],
                                     "uid int, userName string, genres array<string>, "
                                     "firstLogin boolean")
    reqs = spark.createDataFrame([("ann", 1), ("bob", 2), ("bob", 3), ("cy", 4)],
                                 "userName string, req_order long")
    merged, outcomes = users.register_users(existing, reqs)
    assert rows(outcomes) == [("ann", 1, False), ("bob", 2, True), ("bob", 3, False),
                              ("cy", 4, True)]
    m = {r["userName"]: r for r in merged.collect()}
    assert set(m) == {"ann", "bob", "cy"} and m["bob"]["firstLogin"] is True
    assert m["bob"]["uid"] == java_hash("bob") and m["bob"]["genres"] == []
    upd = spark.createDataFrame([("bob", "Action|Drama", 5), ("bob", "War", 7),
                                 ("zed", "Horror", 6)],
                                "userName string, genres string, req_order long")
    after = {r["userName"]: r for r in users.update_user_genres(merged, upd).collect()}
    assert after["bob"]["genres"] == ["War"] and after["bob"]["firstLogin"] is False
    assert after["cy"]["firstLogin"] is True and "zed" not in after


def java_hash(s):
    h = 0
    for ch in s:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_uid_expression(spark):
    df = spark.createDataFrame([("bob",)], "n string")
    assert df.select(java_string_hash("n")).first()[0] == java_hash("bob")


def test_register_into_empty_table(spark):
    reqs = spark.createDataFrame([("amy", 1), ("amy", 2)], "userName string, req_order long")
    merged, outcomes = users.register_users(users.empty_users(spark), reqs)
    assert rows(outcomes) == [("amy", 1, True), ("amy", 2, False)]
    assert [r["userName"] for r in merged.collect()] == ["amy"]


def test_user_record_has_no_password_d15(spark):
    from reelrank.schemas import USER
    assert "password" not in [f.name.lower() for f in USER.fields]
    merged, _ = users.register_users(users.empty_users(spark),
                                     spark.createDataFrame([("x", 1)], "userName string, "
                                                           "req_order long"))
    assert "password" not in [c.lower() for c in merged.columns]


def test_split_genres_as_the_jvm_does(spark):
    from reelrank.functions.scalar import split_genres
    texts = ["a|b|", "a|b", "a||b", "|a", "||", "", None, "a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(split_genres("t")).collect()] == [
        ["a", "b"], ["a", "b"], ["a", "", "b"], ["", "a"], [], [""], None, ["a"]]
