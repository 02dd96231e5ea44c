"""Private data: keyed surrogates of the same type and form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh, let, whole_text
from basketry.materialize import stored

#: Fixed titles by gender; a name is what follows a title.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Señor", "Sr", "Monsieur", "Signor", "г-н", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Señorita", "Madame", "Mme", "Signora", "г-жа", "Госпожа"],
    "n": ["Dr", "Prof", "Professor", "Доктор"],
}
#: Fixed given names by script and gender, for replacements only.
GIVEN = {
    ("latin", "m"): ["Adam", "Boris", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karel", "Leon"],
    ("latin", "f"): ["Alma", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Karin", "Lena"],
    ("latin", "n"): ["Alex", "Charlie", "Dana", "Eden", "Jamie", "Kim", "Lou", "Noa", "Robin", "Sam", "Sasha", "Toni"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Клара", "Лидия", "Мария"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя", "Шура"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "hal", "kin", "lor", "mar", "nev", "pol", "ras", "sen", "tol", "var", "wen", "zel"],
    "cyrillic": ["ба", "ден", "фел", "гор", "хал", "кин", "лор", "мар", "нев", "пол", "рас", "сен", "тол", "вар", "вен", "зел"],
}
ENDINGS = {"latin": "son", "cyrillic": "ов"}

_LETTERS = r"\p{Lu}[\p{L}\p{M}]*(?:['’-]\p{Lu}?[\p{L}\p{M}]+)*"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Tried in this order at every place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "name": rf"(?<![\p{{L}}\p{{M}}])(?:{'|'.join(t for ts in TITLES.values() for t in ts)})(?:\.? ){_LETTERS}(?: {_LETTERS}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_PART = "array<struct<kind:string,value:string>>"


def kind_of(mention: Column) -> Column:
    kind = F.lit("name")
    for name in reversed([k for k in PATTERNS if k != "name"]):
        kind = F.when(mention.rlike(rf"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    return kind


def parts_of(mention: Column) -> Column:
    """What a mention refers to: ``kind, value`` of one entity, or of every part of a name (given names
    by script and gender, surname by script), so that a full name and a surname alone agree."""
    kind = kind_of(mention)
    digits = F.regexp_replace(mention, "[^0-9A-Za-z]", "")
    value = F.when(kind.isin("ip"), mention).when(kind == "email", F.lower(mention)).otherwise(digits)
    single = F.array(F.struct(kind.alias("kind"), value.alias("value")))
    title = F.regexp_extract(mention, r"^([^. ]+)", 1)
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("n")
    words = F.slice(F.split(mention, " "), 2, 3)
    script = lambda w: F.when(w.rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    named = F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i == F.size(words) - 1, F.concat(F.lit("surname:"), script(w)))
            .otherwise(F.concat(F.lit("given:"), script(w), F.lit(":"), gender))
            .alias("kind"),
            F.when((i == F.size(words) - 1) & (gender == "f") & w.rlike("^\\p{IsCyrillic}.*а$"), F.lower(F.regexp_replace(w, "а$", "")))
            .otherwise(F.lower(w))
            .alias("value"),
        ),
    )
    return F.when(kind == "name", named).otherwise(single)


def _draws(key: str, kind: Column, value: Column, attempt: int, count: Column) -> Column:
    """``count`` keyed numbers from 0 to 65,535."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(count / 16).cast("int")),
        lambda b: F.sha2(F.concat_ws("|", F.lit(key), kind, value, F.lit(str(attempt)), b.cast("string")), 256),
    )
    stream = F.array_join(blocks, "")
    return let(
        stream,
        lambda s: F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.conv(F.substring(s, i * 4 + 1, F.lit(4)), 16, 10).cast("int")),
    )


def surrogate(key: str, kind: Column, value: Column, attempt: int) -> Column:
    """A keyed replacement of the same kind and form. Characters keep their class; a phone number its
    first digit, an address its top-level domain, an IBAN its country; a card number that fits the
    Luhn check still does; names come from their own script and gender."""
    length = F.length(value)
    chars = F.split(value, "")

    def exchanged(draws: Column, c: Column, i: Column) -> Column:
        n = F.element_at(draws, i + 1)
        fixed = (
            ((kind == "phone") & (i < 1))
            | ((kind == "iban") & (i < 2))
            | ((kind == "email") & (i >= length - F.length(F.regexp_extract(value, r"(\.[^.]*)$", 1))))
        )
        return (
            F.when(fixed, c)
            .when(c.rlike("^[0-9]$"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike("^[a-z]$"), F.char(F.pmod(n, F.lit(26)) + 97))
            .when(c.rlike("^[A-Z]$"), F.char(F.pmod(n, F.lit(26)) + 65))
            .otherwise(c)
        )

    plain = let(
        _draws(key, kind, value, attempt, length),
        lambda draws: F.array_join(F.transform(chars, lambda c, i: exchanged(draws, c, i)), ""),
    )
    octets = F.array_join(
        F.transform(_draws(key, kind, value, attempt, F.lit(4)), lambda n: (F.pmod(n, F.lit(254)) + 1).cast("string")), "."
    )
    card = F.when(F.call_function("luhn_check", value), F.concat(F.substring(plain, F.lit(1), length - 1), _luhn_digit(F.substring(plain, F.lit(1), length - 1)))).otherwise(plain)
    out = F.when(kind == "ip", octets).when(kind == "card", card).otherwise(plain)
    few = _draws(key, kind, value, attempt, F.lit(8))
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), F.pmod(F.element_at(few, i), F.lit(len(names))) + 1)
    for (script, gender), names in GIVEN.items():
        first = [pick(names, 1 + j) for j in range(1 + min(attempt, 6))]
        out = F.when(kind == f"given:{script}:{gender}", F.lower(F.concat_ws("-", *first))).otherwise(out)
    for script, syllables in SYLLABLES.items():
        body = [pick(syllables, 1 + j) for j in range(3 + min(attempt, 5))]
        out = F.when(kind == f"surname:{script}", F.concat(*body, F.lit(ENDINGS[script]))).otherwise(out)
    return out


def _luhn_digit(body: Column) -> Column:
    n = F.length(body)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda s, i: s
        + F.when(
            F.pmod(n - i, F.lit(2)) == 0,
            F.when(F.substring(body, i, F.lit(1)).cast("int") > 4, F.substring(body, i, F.lit(1)).cast("int") * 2 - 9).otherwise(F.substring(body, i, F.lit(1)).cast("int") * 2),
        ).otherwise(F.substring(body, i, F.lit(1)).cast("int")),
    )
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, replacement`` for distinct ``kind, value``.

    Every round draws a replacement for the entities still open. It is refused if it is itself an
    entity of that kind, is taken, or is drawn twice in the round (the smallest value keeps it), and
    the entity draws again with the next counter. So different entities stay different and no
    replacement is anyone's real value. Open entities fall by orders of magnitude each round; where
    a kind has too few forms for all its entities (a domain full of one-digit names), the
    replacement grows by a counter instead.
    """
    known = stored(entities.select("kind", "value").distinct(), "entities")
    done: DataFrame | None = None
    open_, attempt = known, 0
    while True:
        drawn = open_.select("kind", "value", surrogate(key, F.col("kind"), F.col("value"), attempt).alias("replacement"))
        if attempt >= 8:
            drawn = drawn.withColumn("replacement", F.concat("replacement", F.lit("0"), F.conv(F.substring(F.sha2(F.concat(F.lit(f"{key}{attempt}"), "value"), 256), 1, 8), 16, 10)))
        kept = drawn.groupBy("kind", "replacement").agg(F.min("value").alias("value")).select("kind", "value", "replacement")
        kept = kept.join(known.select("kind", F.col("value").alias("replacement")), ["kind", "replacement"], "left_anti")
        if done is not None:
            kept = kept.join(done.select("kind", "replacement"), ["kind", "replacement"], "left_anti")
        kept = stored(kept.select("kind", "value", "replacement"), "replacements")
        done = kept if done is None else done.unionByName(kept)
        open_ = stored(open_.join(kept, ["kind", "value"], "left_anti"), "open")
        if open_.isEmpty():
            return done
        attempt += 1


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every mention of private data in ``text`` replaced, and ``n_private``, the mentions in it.

    Found are mail and IP addresses, IBANs, social security, card and phone numbers, and names after
    a title. Equal entities get equal replacements in all documents, whatever the form of the
    mention (spaces, brackets, case); different entities get different ones. ``key`` makes the
    mapping secret and repeatable. Only rows with mentions are joined with replacements, and only
    with those of their own mentions.

    Null text stays null and empty text stays empty, both with 0 mentions. Repeated rows are replaced alike. Rows
    without an id are handled like any other. An existing ``n_private`` is replaced. Empty input
    gives an empty result.
    """
    columns = [c for c in docs.columns if c != "n_private"]
    text = whole_text()
    mentions = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    parts = F.flatten(F.transform(F.array_distinct(mentions), parts_of))
    found = stored(
        docs.where(text.rlike(ANY)).select("doc_id", F.explode(F.array_distinct(parts)).alias("p")).select("doc_id", "p.kind", "p.value"), "mentions"
    )
    replacements = surrogate_table(found, key)
    map_id, of_doc = fresh(docs, "map_id", "map")
    maps = (
        found.distinct().join(replacements, ["kind", "value"])
        .groupBy(F.col("doc_id").alias(map_id))
        .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "value"), "replacement"))).alias(of_doc))
    )
    pieces = F.split(text, ANY, -1)
    rendered = F.transform(mentions, lambda m: _rendered(m, F.col(of_doc)))
    woven = F.array_join(F.zip_with(pieces, F.concat(rendered, F.array(F.lit(""))), lambda p, r: F.concat(p, r)), "")
    joined = docs.join(maps, F.col("doc_id").eqNullSafe(F.col(map_id)), "left")
    new = F.when(F.col(of_doc).isNotNull() & text.rlike(ANY), woven).otherwise(F.col("text"))
    return joined.select(
        *[new.alias("text") if c == "text" else F.col(c) for c in columns],
        F.when(F.col(of_doc).isNotNull(), F.size(mentions)).otherwise(0).cast("long").alias("n_private"),
    )


def _rendered(mention: Column, replacements: Column) -> Column:
    looked_up = F.transform(
        parts_of(mention),
        lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), F.element_at(replacements, F.concat_ws("|", p["kind"], p["value"])).alias("new")),
    )
    return let(looked_up, lambda parts: _written(mention, parts))


def _written(mention: Column, parts: Column) -> Column:
    whole = F.element_at(parts, 1)["new"]
    at = lambda i: F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), "[^0-9A-Za-z]", ""))
    positions = F.sequence(F.lit(1), F.length(mention))
    refilled = F.array_join(
        F.transform(
            positions,
            lambda i: F.when(F.substring(mention, i, F.lit(1)).rlike("^[0-9A-Za-z]$"), F.substring(whole, at(i), F.lit(1))).otherwise(F.substring(mention, i, F.lit(1))),
        ),
        "",
    )
    recased = F.array_join(
        F.transform(
            positions,
            lambda i: F.when(F.substring(mention, i, F.lit(1)).rlike("^[A-Z]$"), F.upper(F.substring(whole, i, F.lit(1)))).otherwise(F.substring(whole, i, F.lit(1))),
        ),
        "",
    )
    extra = F.substring(whole, F.length(mention) + 1, F.length(whole))
    names = F.zip_with(
        F.slice(F.split(mention, " "), 2, 3),
        parts,
        lambda old, p: F.when((F.length(old) > 1) & (old == F.upper(old)), F.upper(p["new"]))
        .otherwise(F.initcap(F.replace(p["new"], F.lit("-"), F.lit(" "))))
        .alias("x"),
    )
    feminine = F.zip_with(
        names,
        F.zip_with(F.slice(F.split(mention, " "), 2, 3), parts, lambda old, p: F.length(old) > F.length(p["value"])),
        lambda n, longer: F.replace(F.when(longer, F.concat(n, F.lit("а"))).otherwise(n), F.lit(" "), F.lit("-")),
    )
    title = F.regexp_extract(mention, r"^([^ ]+ )", 1)
    kind = F.element_at(parts, 1)["kind"]
    return (
        F.when(kind == "ip", whole)
        .when(kind == "email", F.concat(recased, extra))
        .when(kind.rlike("^(given|surname)"), F.concat(title, F.array_join(feminine, " ")))
        .otherwise(F.concat(refilled, F.when(F.length(whole) > F.length(F.regexp_replace(mention, "[^0-9A-Za-z]", "")), F.substring(whole, F.length(F.regexp_replace(mention, "[^0-9A-Za-z]", "")) + 1, F.length(whole))).otherwise("")))
    )
