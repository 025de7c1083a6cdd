"""Personal data replaced by keyed surrogates, in DataFrame functions only.

1. One pattern finds e-mail and IP addresses, card, bank, phone and social
   security numbers, secrets after a key word, and names after a title. Types
   come from the value and from the text just before it.
2. The distinct entities (type, canonical value) of all documents get a
   surrogate each, drawn from SHA-512 of key, type, value and attempt. A
   surrogate keeps the class of every character (digit, letter, mark), a
   card's first digit and Luhn remainder, a country prefix, an octet's number
   of digits, a domain's ending; a name keeps gender and script.
3. Collision checks: a surrogate that two entities share, or that is itself a
   value found in the documents, is drawn again for all but the smallest
   entity, until none is left. So distinct entities stay distinct, and each
   entity has one surrogate everywhere (coreference), laid out in the format
   of each occurrence.
4. Occurrences join their surrogates and documents are put together again.
   Only documents with an entity are shuffled. Every text meets the pattern
   once: documents are written with their parts between entities beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmill.llm.common import write_scratch

# Titles and the gender they tell.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа")
OTHER_TITLES = ("Dr", "Prof", "доктор")

# Given names by script and gender, and syllables of family names.
GIVEN = {
    "latin_m": "Adam Alan Bruno Carl Daniel Emil Felix Frank Hugo Ivan Jan Karl Leo Louis Marco Martin Max Oscar Paul Peter Robert Simon Tom Victor".split(),
    "latin_f": "Ada Alice Anna Carla Clara Diana Elena Emma Eva Flora Greta Helen Ida Irene Julia Laura Lena Maria Marta Nina Nora Olga Rosa Sara".split(),
    "latin_x": "Alex Andrea Charlie Chris Dana Jamie Jean Jo Kim Lee Lou Max Robin Sam Sasha Terry".split(),
    "cyrillic_m": "Алексей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей Юрий".split(),
    "cyrillic_f": "Алла Анна Вера Галина Дарья Елена Ирина Лидия Мария Нина Ольга Полина Раиса Софья Тамара Юлия".split(),
    "cyrillic_x": "Женя Саша Валя Слава".split(),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ka ke ko la le li lo ma me mi mo na ne ni no ra re ri ro sa so".split(),
    "cyrillic": "ба бе бо ва ве во га да де до ка ке ко ла ле ли ло ма ме ми мо на не но ра ре ро са се со та то".split(),
}

#: In lower case these are words of their own ("miss London", "5 ms").
_ALSO_WORDS = ("Miss", "Ms", "Sr")


def _forms(titles: tuple[str, ...]) -> str:
    """Titles as given, in capitals and in lower case."""
    return "|".join(dict.fromkeys(f for t in titles for f in (t, t.upper(), t if t in _ALSO_WORDS else t.lower(), t.capitalize())))


_ALL_TITLES = _forms(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)
_TITLE = rf"(?<![\p{{L}}])(?:{_ALL_TITLES})\.? "
_NAME = r"\p{Lu}[\p{L}'’-]{1,40}"
_SECRET_KEYS = "password|passwd|pwd|secret|token|api_key|apikey|access_key"

# The patterns of the entity types, in the order in which they are tried.
PATTERNS = {
    "secret": rf"(?<=[=:\"']|[=: \t][ \t])(?=[^\s\"']{{6}})(?<=(?i:{_SECRET_KEYS})[ \t]{{0,16}}[=:][ \t]{{0,16}}[\"']?)[^\s\"']{{5,}}[^\s\"'.,;:!?)\]}}>]",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "ipv6": r"(?<![\p{L}\p{N}:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\p{L}\p{N}:])"
    r"|(?<![\p{L}\p{N}:])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){1,7}:|::(?=[0-9A-Fa-f]))(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\p{L}\p{N}:])",
    "ip": r"(?<![\p{N}.])(?<!(?i:version|release|build|v)\.?[ ]{0,1})(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.-])(?:[2-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{4,5})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![\p{L}\p{N}])"
    r"|(?<![\p{L}\p{N}+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\p{L}\p{N}-])",
    "name": rf"(?=\p{{Lu}})(?<= )(?:(?<={_TITLE}){_NAME}|(?<={_TITLE}{_NAME} ){_NAME})",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every entity holds a digit, an @, or comes after one of these; most texts need no further look.
_MARKS_LOWER = ("passw", "pwd", "secret", "token", "api_key", "apikey", "access_key")
#: Attempts after which four characters are added (an address changes the lengths of its octets), should a small format be used up.
_LONGER_AFTER = 8


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def split_text(text: Column) -> Column:
    """struct<b, v>: the parts of a text between its entities, and the entities; null if it has none."""
    t = F.coalesce(text, F.lit(""))
    marked = t.rlike("[0-9@]") | t.rlike(rf"(?:{_ALL_TITLES})\.? \p{{Lu}}")
    for m in _MARKS_LOWER:
        marked = marked | F.contains(F.lower(t), F.lit(m))
    some = lambda v: F.when(F.size(v) > 0, F.struct(F.split(t, _ANY, -1).alias("b"), v.alias("v")))
    return F.when(marked, _let(F.regexp_extract_all(t, F.lit(_ANY), F.lit(0)), some))


def occurrences(parts: Column) -> Column:
    """array<struct<pos, type, canonical, value, gender>> of split parts in order; type ``none`` is no entity."""

    def typed(before: Column, value: Column, i: Column, befores: Column, values: Column) -> Column:
        kind = F.when(before.rlike(rf"(?i)({_SECRET_KEYS})[ \t]*[=:][ \t]*[\"']?$"), F.lit("secret"))
        for name, p in PATTERNS.items():
            if name not in ("secret", "name"):
                kind = kind.when(value.rlike(f"^(?:{p})$"), F.lit(name))
        kind = kind.when(value.rlike("[0-9]"), F.lit("secret")).otherwise(F.lit("name"))
        script = F.when(value.rlike(r"^\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
        titled = before.rlike(_TITLE + "$")
        goes_on = F.coalesce((F.get(befores, i + 1) == " ") & F.get(values, i + 1).rlike(rf"^{_NAME}$"), F.lit(False))
        gender = (
            F.when(before.rlike(rf"(?<!\p{{L}})(?:{_forms(MALE_TITLES)})\.? $"), F.lit("m"))
            .when(before.rlike(rf"(?<!\p{{L}})(?:{_forms(FEMALE_TITLES)})\.? $"), F.lit("f"))
            .otherwise(F.lit("x"))
        )
        given = titled & goes_on
        person = F.concat(F.when(given, F.lit("given_")).otherwise(F.lit("family_")), script)
        type_ = F.when(kind == "name", person).otherwise(kind)
        canonical = (
            F.when(type_.isin("email", "ipv6"), F.lower(value))
            .when(type_.isin("card", "ssn"), F.regexp_replace(value, "[^0-9]", ""))
            # Ten digits are the same number with and without the country prefix 1.
            .when(type_ == "phone", F.regexp_replace(F.regexp_replace(value, "[^0-9+]", ""), r"^\+1([0-9]{10})$", "$1"))
            .when(type_.startswith("given_") | type_.startswith("family_"), F.lower(value))
            .when(type_ == "iban", F.regexp_replace(value, " ", ""))
            .otherwise(value)
        )
        # A number of a card's length that fails its check digit is no card.
        type_ = F.when((type_ == "card") & (_luhn(canonical) != 0), F.lit("none")).otherwise(type_)
        told = F.when(type_.startswith("given_"), gender).otherwise(F.lit("x"))
        return F.struct(i.alias("pos"), type_.alias("type"), canonical.alias("canonical"), value.alias("value"), told.alias("gender"))

    return _let(parts, lambda s: F.transform(s["v"], lambda v, i: typed(F.get(s["b"], i), v, i, s["b"], s["v"])))


def _byte(stream: Column, k: Column) -> Column:
    """The k-th number below 65536 of a hex stream."""
    return F.conv(F.substring(stream, k * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _pick(words: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (n % len(words)) + 1)


def surrogate(kind: Column, canonical: Column, gender: Column, attempt: int, key: str) -> Column:
    """The surrogate of one entity at one attempt."""
    chunks = F.sequence(F.lit(0), F.floor(F.length(canonical) / 28).cast("int") + 1)
    stream = F.array_join(
        F.transform(chunks, lambda c: F.sha2(F.concat_ws("\u001f", F.lit(key), kind, canonical, F.lit(str(attempt)), c.cast("string")).cast("binary"), 512)), ""
    )
    letters, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    head = F.when(kind == "phone", F.when(canonical.startswith("+"), 2).otherwise(0)).when(kind == "card", 1).when(kind == "iban", 2).otherwise(0)
    tail = F.when(kind == "email", F.length(F.regexp_extract(canonical, r"\.[^.]*$", 0))).otherwise(0)
    draw = F.substring(canonical, head + 1, F.length(canonical) - head - tail)

    def by_class(s: Column) -> Column:
        def one(c: Column, k: Column) -> Column:
            n = _byte(s, k)
            return (
                F.when(c.rlike("[0-9]"), F.substring(F.lit("0123456789"), n % 10 + 1, F.lit(1)))
                .when((kind == "ipv6") & c.rlike("[a-f]"), F.substring(F.lit("abcdef"), n % 6 + 1, F.lit(1)))
                .when(c.rlike(r"\p{Lu}"), F.substring(F.lit(upper), n % 26 + 1, F.lit(1)))
                .when(c.rlike(r"\p{L}"), F.substring(F.lit(letters), n % 26 + 1, F.lit(1)))
                .otherwise(c)
            )

        body = F.array_join(F.transform(F.filter(F.split(draw, ""), lambda c: c != ""), one), "")
        more = F.lit("")
        if attempt >= _LONGER_AFTER:
            four = F.lpad((_byte(s, F.lit(5)) % 10000).cast("string"), 4, "0")
            more = F.when(kind.isin("email", "secret"), F.substring(s, F.lit(1), F.lit(4))).otherwise(four)
            more = F.when((kind == "ipv6") & ~canonical.endswith(":"), F.concat(F.lit(":"), four)).otherwise(more)  # a group of its own
        drawn = F.concat(F.substring(canonical, F.lit(1), head), F.when(kind == "email", F.concat(more, body)).otherwise(F.concat(body, more)))
        return F.concat(drawn, F.substring(canonical, F.length(canonical) - tail + 1, tail))

    def octets(s: Column) -> Column:
        def one(o: Column, k: Column) -> Column:
            n = _byte(s, k)
            if attempt >= _LONGER_AFTER:  # any length
                return (1 + n % 255).cast("string")
            return F.when(F.length(o) == 3, 100 + n % 156).when(F.length(o) == 2, 10 + n % 90).otherwise(1 + n % 9).cast("string")

        return F.array_join(F.transform(F.split(canonical, "\\."), one), ".")

    def person(s: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, names in GIVEN.items():
            base = _pick(names, _byte(s, F.lit(0)))
            if attempt:  # the plain list is used up sooner or later
                base = F.concat(base, F.lit("-"), F.initcap(F.concat(*[_pick(SYLLABLES[name.split("_")[0]], _byte(s, F.lit(1 + j))) for j in range(1 + attempt)])))
            script, own = name.split("_")
            out = F.when((kind == f"given_{script}") & (gender == own), base).otherwise(out)
        for script, parts in SYLLABLES.items():
            word = F.initcap(F.concat(*[_pick(parts, _byte(s, F.lit(j))) for j in range(4 + attempt)]))
            out = F.when(kind == f"family_{script}", word).otherwise(out)
        return out

    drawn = _let(
        stream,
        lambda s: F.when(kind == "ip", octets(s)).when(kind.startswith("given_") | kind.startswith("family_"), person(s)).otherwise(by_class(s)),
    )
    return F.when(kind == "card", _like_luhn(canonical, drawn)).otherwise(drawn)


def _luhn(digits: Column) -> Column:
    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return F.when((F.length(digits) - i) % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), one), F.lit(0), lambda a, x: a + x) % 10


def _like_luhn(real: Column, drawn: Column) -> Column:
    """The drawn number with its last digit turned so that both leave the same Luhn remainder."""
    last = F.substring(drawn, F.length(drawn), F.lit(1)).cast("int")
    fixed = (last + _luhn(real) - _luhn(drawn) + 20) % 10
    return F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), fixed.cast("string"))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, canonical, gender) rows to (type, canonical, surrogate): one each, all different, none a real value.

    Types whose values look alike are checked together (all digits of cards,
    phones and the rest in one space), so no surrogate is a value of another
    type. Names are compared without regard to capitals. Attempts go on until
    every entity has one: from some attempt on, surrogates grow longer.
    """
    men, women = F.max(F.col("gender") == "m"), F.max(F.col("gender") == "f")
    told = F.when(men & ~women, "m").when(women & ~men, "f").otherwise("x")
    left = write_scratch(entities.groupBy("type", "canonical").agg(told.alias("gender")), "entities")
    real = left.select(F.lower("canonical").alias("_like")).distinct()
    spark = entities.sparkSession
    done = spark.createDataFrame([], "type string, canonical string, surrogate string")
    attempt = 0
    while not left.isEmpty():
        drawn = left.select("type", "canonical", surrogate(F.col("type"), F.col("canonical"), F.col("gender"), attempt, key).alias("surrogate"))
        drawn = drawn.withColumn("_like", F.lower("surrogate"))
        taken = real.unionByName(done.select(F.lower("surrogate").alias("_like")))
        free = drawn.join(taken, "_like", "left_anti")
        first = free.groupBy("_like").agg(F.min(F.struct("type", "canonical", "surrogate")).alias("f")).select("f.*")
        fresh = write_scratch(first, "surrogates")
        done = done.unionByName(fresh)
        left = write_scratch(left.join(fresh, ["type", "canonical"], "left_anti"), "entities-left")
        attempt += 1
    return done


def _laid_out(kind: Column, value: Column, sur: Column) -> Column:
    """The canonical surrogate in the format of an occurrence: its marks, blanks and capitals."""

    def numbers(value: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), "[^\\p{L}\\p{N}+]", ""))
            return F.when(c.rlike("[\\p{L}\\p{N}+]"), F.substring(sur, before + 1, F.lit(1))).otherwise(c)

        chars = F.filter(F.split(value, ""), lambda c: c != "")
        room = F.length(F.regexp_replace(value, "[^\\p{L}\\p{N}+]", ""))
        return F.concat(F.array_join(F.transform(chars, one), ""), F.substring(sur, room + 1, F.length(sur)))

    def capitals() -> Column:
        chars = F.filter(F.split(sur, ""), lambda c: c != "")
        return F.array_join(
            F.transform(chars, lambda c, i: F.when(F.substring(value, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), ""
        )

    prefix = F.regexp_extract(value, r"^\+1[ .-]?", 0)
    prefixed = (kind == "phone") & (F.length(prefix) > 0) & (F.length(F.regexp_replace(value, "[^0-9]", "")) == 11)
    name = kind.startswith("given_") | kind.startswith("family_")
    return (
        F.when(prefixed, F.concat(prefix, numbers(F.substring(value, F.length(prefix) + 1, F.length(value)))))
        .when(kind.isin("card", "ssn", "phone", "iban"), numbers(value))
        .when(kind.isin("email", "ipv6") & (value != F.lower(value)), capitals())
        .when(name & (value == F.upper(value)) & (F.length(value) > 1), F.upper(sur))
        .otherwise(sur)
    )


def replace_entities(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None
) -> DataFrame:
    """``docs`` with surrogates in its text; ``count_col`` adds the number of entities replaced.

    Null and empty texts stay as they are. Repeated rows and null ids are
    treated alike: a row's text decides. All other columns are kept, whatever
    their names; one named like ``count_col`` is replaced by it. An empty table
    gives an empty result.
    """
    own = [c for c in docs.columns if c != count_col]
    held = ["_k", "_d", "_r", "_s", "_n", "_p"]
    while set(held) & set(own):
        held = [h + "_" for h in held]
    k, d, r, s, n, p = held
    text = F.col(f"`{text_col}`")
    kept = [F.col(f"`{c}`") for c in own]
    digest = F.when(F.col(p).isNotNull(), F.sha2(text.cast("binary"), 256))
    # The texts of documents with an entity are held as their parts only.
    split = docs.select(*kept, split_text(text).alias(p)).withColumn(r, digest)
    split = split.select(*[F.when(F.col(p).isNull(), text).alias(c) if c == text_col else F.col(f"`{c}`") for c in own], p, r)
    rows = write_scratch(split, "split-texts")

    marked = rows.filter(F.col(p).isNotNull())
    found = marked.select(F.col(f"`{id_col}`").alias("id"), F.col(r).alias("d"), F.inline(occurrences(F.col(p))))
    found = write_scratch(found.distinct(), "occurrences")
    table = surrogates(found.filter("type <> 'none'"), key)
    new = (
        found.join(table, ["type", "canonical"], "left")
        .select("id", "d", "pos", "type", F.coalesce(_laid_out(F.col("type"), F.col("value"), F.col("surrogate")), "value").alias("new"))
        .groupBy("id", "d")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("_new"), F.count_if(F.col("type") != "none").alias("_n"))
        .select(F.col("id").alias(k), F.col("d").alias(d), F.col("_new.new").alias(s), F.col("_n").alias(n))
    )
    parts = F.col(p).getField("b")
    whole = F.array_join(F.flatten(F.transform(parts, lambda x, i: F.array(x, F.coalesce(F.get(F.col(s), i), F.lit(""))))), "")
    changed = marked.join(new, F.col(f"`{id_col}`").eqNullSafe(F.col(k)) & (F.col(r) == F.col(d)))
    extra = lambda c: [c.cast("long").alias(count_col)] if count_col else []
    with_new = changed.select(*[whole.alias(c) if c == text_col else F.col(f"`{c}`") for c in own], *extra(F.col(n)))
    return rows.filter(F.col(p).isNull()).select(*kept, *extra(F.lit(0))).unionByName(with_new)
