"""PII surrogates, in DataFrame functions only.

Detected mentions (e-mail, phone, IP address, card, social security and bank
account number, secrets, names after a title) are replaced by keyed surrogates
of the same type: same digits count and punctuation, letter case, country or
issuer prefix, Luhn-valid cards, and names of the same gender and script.

Surrogates belong to entities, not mentions: one phone number written in two
ways, or a surname with and without a given name, keeps one surrogate in the
whole corpus (coreference). Two entities never share a surrogate, and no
surrogate equals an entity of the corpus: draws that collide are repeated with
the next attempt number until none does (distinctness).

Texts are shuffled only if they hold a mention; mentions are grouped before
joins, and texts that are copies of one another are worked out once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import Scratch, cut, read

#: Titles by gender, and listed names by gender and script.
TITLES = {"m": "Mr|Herr|Monsieur|Señor|г-н|господин", "f": "Mrs|Ms|Miss|Mme|Madame|Frau|Señora|Sra|г-жа|госпожа",
          "n": "Dr|Prof|д-р"}
GIVEN = {
    "latin_m": "Adam Anton Bruno Carl David Emil Felix Georg Henry Ivan Jonas Karl Leon Marco Nico Oscar Paul Robin Simon Thomas Victor Walter",
    "latin_f": "Ada Anna Bella Clara Diana Emma Flora Grace Helen Irene Julia Karla Laura Maria Nina Olivia Paula Rosa Sofia Teresa Vera Wanda",
    "latin_n": "Alex Ariel Blake Casey Charlie Dana Eden Finley Jamie Jordan Kim Lee Morgan Noel Quinn Riley Robin Sam Sasha Sidney Taylor Toni",
    "cyrillic_m": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Николай Олег Павел Роман Сергей Тимур Фёдор Юрий",
    "cyrillic_f": "Анна Вера Галина Дарья Елена Жанна Зоя Инна Клара Лидия Мария Нина Ольга Полина Раиса София Тамара Юлия",
    "cyrillic_n": "Валя Женя Саша Слава Шура",
}
SURNAMES = {
    "latin": "Abbott Becker Castell Dahlberg Ellery Fischer Garner Holm Ibsen Jansen Keller Lindt Mercer Norden Olsen Pereira Quist Renner Sander Tanner Ulmer Vogel Winter Yates Zeller",
    "cyrillic_m": "Абрамов Белов Волков Громов Данилов Ершов Жуков Зайцев Иванов Крылов Лебедев Морозов Носов Орлов Павлов Рыбаков Соколов Титов",
    "cyrillic_f": "Абрамова Белова Волкова Громова Данилова Ершова Жукова Зайцева Иванова Крылова Лебедева Морозова Носова Орлова Павлова Рыбакова Соколова Титова",
}

_NAME = r"\p{Lu}[\p{Ll}\p{Lu}'’-]{1,40}"
_LABEL = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: type -> pattern of a whole mention; earlier ones win.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "secret": _LABEL + r"[A-Za-z0-9+/_.~-]{6,}+",
    "access": r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "ip": rf"(?<!\d\.)(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "phone": r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|\+\d{11,13}(?!\d)",
    "card": r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?!\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\d)",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": "(?:" + "|".join(TITLES.values()) + r")\.? +" + _NAME + rf"(?: {_NAME}){{0,2}}",
}
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(PATTERNS.values()) + ")"

MAX_ATTEMPTS = 64


def mentions_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def kind_of(mention: Column) -> Column:
    out = None
    for kind, pattern in PATTERNS.items():
        is_it = mention.rlike(f"^(?:{pattern})$")
        out = F.when(is_it, kind) if out is None else out.when(is_it, kind)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def entities_of(mention: Column, kind: Column) -> Column:
    """array of struct(kind, value): the entities that a mention names."""
    one = lambda k, v: F.array(F.struct(k.alias("kind"), v.alias("value")))
    title = F.regexp_extract(mention, r"^([\p{L}-]+)", 1)
    gender = F.when(title.rlike(f"^({TITLES['m']})$"), "m") \
        .when(title.rlike(f"^({TITLES['f']})$"), "f").otherwise("n")
    names = F.split(F.regexp_replace(mention, r"^[\p{L}-]+\.? +", ""), " +")
    script = F.when(mention.rlike(r"\p{IsCyrillic} *$"), "cyrillic").otherwise("latin")
    # a Cyrillic surname tells its own form, whatever the title
    family = lambda x: F.when(script == "latin", F.lit("surname:latin")).otherwise(
        F.concat(F.lit("surname:cyrillic_"), F.when(x.rlike("[ая]$"), "f").otherwise("m")))
    people = F.transform(names, lambda x, i: F.struct(
        F.when(i == F.size(names) - 1, family(x))
        .otherwise(F.concat(F.lit("given:"), script, F.lit("_"), gender)).alias("kind"),
        x.alias("value")))
    return F.when(kind == "person", people) \
        .when(kind == "email", one(kind, F.lower(mention))) \
        .when(kind == "phone", one(kind, F.substring(_digits(mention), -10, 10))) \
        .when(kind.isin("card", "ssn"), one(kind, _digits(mention))) \
        .when(kind == "iban", one(kind, F.regexp_replace(mention, " ", ""))) \
        .when(kind == "secret", one(F.lit("secret"),
                                    F.regexp_replace(mention, "^" + _LABEL, ""))) \
        .when(kind == "access", one(F.lit("secret"), mention)).otherwise(one(kind, mention))


def _redrawn(value: Column, stream: Column, keep: int = 0) -> Column:
    """``value`` with every ASCII letter and digit after the first ``keep`` drawn anew,
    case kept, and hexadecimal strings staying so. ``stream`` is hexadecimal."""
    is_hex = value.rlike("^(?=.*[a-f])[0-9a-f]{12,}$")

    def sign(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        byte = F.conv(F.substring(stream, 2 * F.pmod(i, F.lit(120)) + 1, F.lit(2)), 16, 10).cast("int")
        return F.when(i <= keep, c).when(is_hex, F.substring(stream, 2 * F.pmod(i, F.lit(120)) + 1, F.lit(1))) \
            .when(c.rlike("[0-9]"), (byte % 10).cast("string")) \
            .when(c.rlike("[a-z]"), F.char(97 + byte % 26)) \
            .when(c.rlike("[A-Z]"), F.char(65 + byte % 26)).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), sign), "")


def _luhn(front: Column) -> Column:
    """``front`` with its Luhn check digit."""
    n = F.length(front)

    def add(i: Column) -> Column:
        d = F.substring(front, i, F.lit(1)).try_cast("int")  # null for other kinds
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(F.pmod(n - i, F.lit(2)) == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), add), F.lit(0), lambda a, x: a + x)
    return F.concat(front, ((10 - total % 10) % 10).cast("string"))


def _listed(names: str, stream: Column, attempt: int) -> Column:
    """A name of the list; each further two attempts join one more by a hyphen."""
    table = names.split()
    pick = lambda k: F.get(F.split(F.lit(names), " "), F.conv(
        F.substring(stream, 6 * k + 1, 6), 16, 10).cast("int") % len(table))
    return F.concat_ws("-", *[pick(k) for k in range(1 + attempt // 2)])


def stream_of(kind: Column, value: Column, attempt: int, key: str) -> Column:
    """256 hexadecimal digits that the key, the entity and the attempt determine."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(f"{key}\x1f{i}\x1f{attempt}"), kind, value),
                             256) for i in range(4)])


def draw(kind: Column, value: Column, attempt: int, stream: Column) -> Column:
    """The ``attempt``-th surrogate of an entity, from its stream."""
    number = lambda at, size: F.conv(F.substring(stream, at, 12), 16, 10).cast("long") % size
    more = F.substring(F.translate(stream, "0123456789", "ghijklmnop"), 1, attempt // 4)
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    out = F.when(kind == "email", F.concat(
        _redrawn(local, stream), more, F.lit("@"),
        _redrawn(F.substring_index(domain, ".", 1), F.substring(stream, 121, 240)), F.lit("."),
        F.substring(domain, F.length(F.substring_index(domain, ".", 1)) + 2, F.length(domain))))
    out = out.when(kind == "phone", F.concat(
        (number(1, 800) + 200).cast("string"), (number(13, 800) + 200).cast("string"),
        F.lpad(number(25, 10_000).cast("string"), 4, "0")))
    out = out.when(kind == "ip", F.concat_ws(".", *[
        (number(12 * i + 1, 222) + 1).cast("string") for i in range(4)]))
    out = out.when(kind == "card", _luhn(F.substring(
        _redrawn(value, stream, 1), F.lit(1), F.length(value) - 1)))
    out = out.when(kind == "iban", _redrawn(value, stream, 2))
    out = out.when((kind == "secret") & value.startswith("AKIA"), _redrawn(value, stream, 4))
    for name, names in GIVEN.items():
        out = out.when(kind == f"given:{name}", _listed(names, stream, attempt))
    for name, names in SURNAMES.items():
        out = out.when(kind == f"surname:{name}", _listed(names, stream, attempt))
    return out.otherwise(_redrawn(value, stream))


def surrogates(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, value) rows, distinct -> (kind, value, surrogate), distinct per kind and never
    an entity of that kind. Of entities that draw the same surrogate the
    alphabetically first keeps it; the others draw again."""
    fixed = None
    pending = entities.select("kind", "value")
    for attempt in range(MAX_ATTEMPTS):
        drawn = scratch.cut(pending.withColumn(
            "stream", stream_of(F.col("kind"), F.col("value"), attempt, key)).select(
            "kind", "value", draw(F.col("kind"), F.col("value"), attempt, F.col("stream"))
            .alias("surrogate")), "pii_drawn")
        taken = entities.select("kind", F.col("value").alias("surrogate"))
        if fixed is not None:
            taken = taken.union(fixed.select("kind", "surrogate"))
        good = drawn.join(taken.distinct(), ["kind", "surrogate"], "left_anti") \
            .groupBy("kind", "surrogate").agg(F.min("value").alias("value")) \
            .select("kind", "value", "surrogate")
        good = scratch.cut(good, "pii_good")
        fixed = good if fixed is None else fixed.union(good)
        pending = scratch.cut(drawn.select("kind", "value")
                         .join(good.select("kind", "value"), ["kind", "value"], "left_anti"),
                         "pii_pending")
        if pending.isEmpty():
            return fixed
    raise RuntimeError(f"no free surrogates after {MAX_ATTEMPTS} attempts")


def _in_format(mention: Column, digits: Column) -> Column:
    """``mention`` with its last digits replaced by ``digits``, punctuation kept."""
    skip = F.length(_digits(mention)) - F.length(digits)

    def sign(i: Column) -> Column:
        c = F.substring(mention, i, F.lit(1))
        at = F.length(_digits(F.substring(mention, F.lit(1), i))) - skip
        return F.when(c.rlike("[0-9]") & (at > 0), F.substring(digits, at, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(mention)), sign), "")


def mention_surrogates(mentions: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(mention), distinct -> (mention, replacement)."""
    kind = kind_of(F.col("mention"))
    m = mentions.withColumn("mkind", kind).select(
        "mention", "mkind", F.posexplode(entities_of(F.col("mention"), F.col("mkind"))).alias("pos", "e"))
    m = scratch.cut(m.select("mention", "mkind", "pos", F.col("e.kind").alias("kind"),
                        F.col("e.value").alias("value")), "pii_mentions")
    # a given name is one entity under all titles: the gender that most mentions tell, if any
    base = F.regexp_extract("kind", "^(given:[a-z]+)_", 1).alias("base")
    tells = lambda g: F.count_if(F.col("kind").endswith(f"_{g}"))
    genders = m.filter("kind like 'given:%'").groupBy(base, "value").agg(tells("m").alias("m"), tells("f").alias("f")).select(
        "base", "value", F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > 0, "m").otherwise("n").alias("gender"))
    m = scratch.cut(m.withColumn("base", base).join(genders, ["base", "value"], "left").withColumn(
        "kind", F.when(F.col("gender").isNotNull(), F.concat("base", F.lit("_"), "gender")).otherwise(F.col("kind")))
        .drop("base", "gender"), "pii_gendered")
    entities = scratch.cut(m.select("kind", "value").distinct(), "pii_entities")
    drawn = scratch.cut(surrogates(entities, key, scratch), "pii_surrogates")
    parts = m.join(drawn, ["kind", "value"]).groupBy("mention", "mkind").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "surrogate"))),
                    lambda x: x["surrogate"]).alias("s"))
    first, text, kind = F.get("s", F.lit(0)), F.col("mention"), F.col("mkind")
    grouped = F.regexp_replace(text, "[A-Z0-9]", "")     # spaces of a bank account number
    return parts.select("mention", F.when(kind.isin("phone", "card", "ssn"), _in_format(text, first))
                        .when(kind == "secret", F.concat(F.regexp_extract(text, f"^({_LABEL})", 1), first))
                        .when(kind == "person", F.concat(
                            F.regexp_extract(text, r"^([\p{L}-]+\.? +)", 1), F.array_join("s", " ")))
                        .when((kind == "iban") & (grouped != ""),
                              F.trim(F.regexp_replace(first, "(.{4})", "$1 ")))
                        .otherwise(first).alias("replacement"))


def replace(docs: DataFrame, key: str, *, text_col: str = "text", count_col: str | None = None
            ) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; ``count_col`` adds the number of mentions.

    Whole texts are searched. Null and empty texts, and texts without a mention, come
    back unchanged (0 mentions). Repeated rows, null ids and other columns are
    kept as they are; an empty table gives an empty result. The same key, corpus and
    entities give the same surrogates, wherever and how often they are named.
    """
    cols = docs.columns
    rows = docs.select(F.struct(*cols).alias("__row"), F.col(text_col).alias("__text"))
    has = F.coalesce(F.col("__text").rlike(ANY), F.lit(False))
    hit = rows.filter(has)
    scratch = Scratch(docs.sparkSession)
    # one row for each different text that holds mentions
    texts = scratch.cut(hit.select(F.sha2("__text", 256).alias("sha"),
                              mentions_of(F.col("__text")).alias("found"))
                   .groupBy("sha").agg(F.any_value("found").alias("found")), "pii_texts")
    named = scratch.cut(texts.select("sha", F.posexplode("found").alias("pos", "mention")), "pii_named")
    answers = scratch.cut(mention_surrogates(named.select("mention").distinct(), key, scratch), "pii_answers")
    answers = named.join(answers, "mention").groupBy("sha").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "replacement"))),
                    lambda x: x["replacement"]).alias("new"))
    answers, _ = cut(answers, "pii_by_text")
    scratch.clear()
    between = F.split(F.col("__text"), ANY, -1)
    text = F.array_join(F.flatten(F.zip_with(
        between, F.concat("new", F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    done = hit.withColumn("sha", F.sha2("__text", 256)).join(answers, "sha").select(
        "__row", text.alias("__text"), F.size("new").cast("long").alias("__n"))
    out = done.unionByName(rows.filter(~has).withColumn("__n", F.lit(0).cast("long")))
    kept = [F.col("__text").alias(c) if c == text_col else F.col("__row")[c].alias(c)
            for c in cols if c != count_col]
    return out.select(*kept, *([F.col("__n").alias(count_col)] if count_col else []))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("reelrank.pii.key", "reelrank")
    return replace(read(spark, sf_dir, "documents").select("doc_id", "text"), key,
                   count_col="n_mentions")
