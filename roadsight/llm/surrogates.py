"""Surrogates for personal data: keyed replacements that keep type, gender, script and format.

Patterns find e-mail addresses, secrets, account and card numbers, network addresses, telephone and
social security numbers, and persons: capitalised names after a title, after a known given name, or
after words that announce a name.  Numbers like cards whose check digit is wrong are no cards and stay.
Entities that differ only in case or separators share a canonical form, and so a surrogate core
(coreference); a person is the same with a neutral title and without.  The core comes from SHA-256 of a
key, the type and the canonical form, character by character: digits give digits, letters give letters
of their script, addresses stay addresses, cards and IBANs keep valid check digits, persons get a given
name of their gender.  Cores that meet another core or any real entity of the corpus are drawn anew until
none does (distinctness), and made longer where their length leaves too little room.  The core is then
laid out like the entity: same separators, same case.

All of it is DataFrame expressions.  A text is searched once, by the patterns that a cheap test of
it calls for; only texts that hold entities are split and joined with their surrogates, by a row number
that is written with the rows.  Null and empty texts stay; rows without entity stay as they are; repeated
rows get the same replacement; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadsight.llm.common import stage

# fixed values: titles and given names by gender, as they are used in the languages of the corpus
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа"],
          "m": ["Mr", "Herr", "Señor", "Monsieur", "Господин"],
          "n": ["Dr", "Prof"]}
NAMES = {
    ("f", "latin"): ["Mary", "Anna", "Laura", "Sofia", "Emma", "Julia", "Carmen", "Claire", "Helen", "Ruth", "Alice", "Ingrid"],
    ("m", "latin"): ["John", "Peter", "Thomas", "Carlos", "Paul", "David", "Henri", "Robert", "Stefan", "Miguel", "James", "Karl"],
    ("n", "latin"): ["Robin", "Alex", "Kim", "Sascha", "Dominique", "Noa", "Andrea", "Charlie"],
    ("f", "cyrillic"): ["Анна", "Мария", "Елена", "Ольга", "Ирина", "Софья"],
    ("m", "cyrillic"): ["Иван", "Пётр", "Сергей", "Андрей", "Олег", "Павел"],
    ("n", "cyrillic"): ["Саша", "Женя", "Валя"],
    ("f", "greek"): ["Μαρία", "Ελένη", "Άννα", "Σοφία"],
    ("m", "greek"): ["Γιώργος", "Νίκος", "Πέτρος", "Ανδρέας"],
    ("n", "greek"): ["Άρης", "Χάρις"],
}

# fixed values: words that announce a name
CUES = ["name is", "name:", "named", "called", "contact", "contact:", "author:", "by", "from", "from:", "to:", "cc:", "dear", "met", "meet",
        "signed", "sincerely,", "regards,", "je m'appelle", "nom:", "heiße", "heißt", "name ist", "me llamo", "nombre:", "se llama"]

_ALNUM = r"\p{L}\p{N}"
EMAIL = rf"(?<![{_ALNUM}._%+-])[{_ALNUM}._%+-]++@[{_ALNUM}-]++(?:\.[{_ALNUM}-]++)++"
SECRET = (rf"(?<![{_ALNUM}])(?:[0-9a-fA-F]{{32,}}+|(?:AKIA|ASIA)[0-9A-Z]{{16,}}+|(?:sk|pk|ghp|xoxb)[_-][0-9A-Za-z_-]{{20,}}+)"
          rf"(?![{_ALNUM}])")
IBAN = rf"(?<![{_ALNUM}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_ALNUM}])"
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
PHONE = (r"(?:(?<![\d+])\+[1-9](?:[ ./()-]{0,2}\d){6,14}(?!\d)"
         r"|(?<!\d)(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3,4}[ .-]\d{4}(?!\d))")
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_WORD = r"\p{Lu}[\p{L}'’-]+"
_NAME = rf"\p{{Lu}}[\p{{L}}'’-]*\p{{Ll}}(?: \p{{Lu}}\.)?(?: \p{{Lu}}[\p{{L}}'’-]*\p{{Ll}}){{1,2}}"
_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
_GIVEN = "|".join(n for ns in NAMES.values() for n in ns)
_CUE = "|".join(rf"(?<=\b(?i:{c}) )" for c in CUES)
PERSON = (rf"(?=\p{{Lu}})(?<![{_ALNUM}])(?:(?:{_TITLE})\.? {_WORD}(?: {_WORD})?|(?:{_GIVEN}) {_WORD}|(?:{_CUE}){_NAME})"
          rf"(?![{_ALNUM}])")

#: In the order in which they are tried.
TYPES = [("email", EMAIL), ("secret", SECRET), ("iban", IBAN), ("card", CARD), ("ip", IP), ("ssn", SSN),
         ("phone", PHONE), ("person", PERSON)]
#: Cheap tests of a text for each kind that an entity of it cannot fail.
_MAY_MAIL = r"[\p{L}\p{N}._%+-]@[\p{L}\p{N}-]"
_MAY_NUMBER = r"[0-9][^\p{L}\n]{0,8}[0-9][^\p{L}\n]{0,8}[0-9][^\p{L}\n]{0,8}[0-9]|[0-9A-Za-z_-]{20}"
_MAY_NAME = r"\p{Lu}\p{L}*\.? \p{Lu}"
_NUMBERS = ("secret", "iban", "card", "ip", "ssn", "phone")

DEFAULT_KEY = "surrogates-1"
#: Draws of a core's own length; after them every draw adds characters.
PLAIN_DRAWS = 4


def _any(*kinds: str) -> str:
    return "|".join(f"(?:{p})" for n, p in TYPES if n in kinds)


def _by_need(text: Column, fn, otherwise: Column) -> Column:
    """``fn(pattern)`` for the kinds that a text may hold."""
    mail, number, name = F.col("__mail"), F.col("__number"), F.col("__name")
    return (F.when(mail, fn(_any(*(n for n, _ in TYPES)))).when(number & name, fn(_any(*_NUMBERS, "person")))
            .when(number, fn(_any(*_NUMBERS))).when(name, fn(_any("person"))).otherwise(otherwise))


def with_needs(rows: DataFrame) -> DataFrame:
    text = F.col("text")
    test = lambda p: F.coalesce(text.rlike(p), F.lit(False))
    return rows.withColumns({"__mail": F.coalesce(F.contains(text, F.lit("@")), F.lit(False)) & test(_MAY_MAIL),
                             "__number": test(_MAY_NUMBER), "__name": test(_MAY_NAME)})


def entities(text: Column) -> Column:
    """All entities of a text, in order (of rows that went through :func:`with_needs`)."""
    return _by_need(text, lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0)), F.array().cast("array<string>"))


def _kind(entity: Column) -> Column:
    out = F.lit("person")
    for name, pattern in reversed(TYPES[:-1]):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def _lowered(entity: Column) -> Column:
    low = F.lower(entity)
    return F.when(F.length(low) == F.length(entity), low).otherwise(entity)


def _titleless(entity: Column) -> Column:
    return F.regexp_replace(entity, rf"^(?:{_TITLE})\.? ", "")


def described(found: DataFrame) -> DataFrame:
    """(entity) to (entity, kind, body, canonical, gender, script).

    ``body`` is what gets replaced (a person without the title); ``canonical`` what coreference goes by.
    """
    entity, kind = F.col("entity"), F.col("kind")
    gender = F.lit("n")
    for g in ("m", "f"):  # the given name says it where the title does not
        given = "|".join(n for (gg, _), ns in NAMES.items() if gg == g for n in ns)
        gender = F.when(F.col("body").rlike(rf"^(?:{given}) "), g).otherwise(gender)
    for g in ("m", "f"):
        gender = F.when(entity.rlike(rf"^(?:{'|'.join(TITLES[g])})\.? "), g).otherwise(gender)
    script = (F.when(entity.rlike(r"\p{IsCyrillic}"), "cyrillic").when(entity.rlike(r"\p{IsGreek}"), "greek").otherwise("latin"))
    body = F.when(kind == "person", _titleless(entity)).otherwise(entity)
    canonical = (F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace("body", r"\D", ""))
                 .when(kind == "iban", F.regexp_replace("body", " ", ""))
                 .when(kind == "person", F.concat_ws("|", "gender", "script", F.lower("body")))
                 .otherwise(_lowered(F.col("body"))))
    out = (found.withColumn("kind", _kind(entity)).withColumn("body", body).withColumn("gender", gender)
           .withColumn("script", script).withColumn("canonical", canonical))
    return out.where((kind != "card") | (_luhn(F.col("canonical")) % 10 == 0))


def _stream(attempt: int, key: str) -> Column:
    """Keyed hex digits, two for each character of the canonical form and 64 over."""
    blocks = F.sequence(F.lit(0), F.ceil(F.length("canonical") / 32).cast("int") + 1)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(
        F.concat_ws("\u0001", F.lit(key), "kind", "canonical", F.lit(attempt).cast("string"), b.cast("string")), 256)), "")


def _byte(at: Column) -> Column:
    return F.conv(F.substr(F.col("stream"), at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _char(c: Column, at: Column) -> Column:
    """A keyed character of the same class and script."""
    byte = _byte(at)
    accents = "àáâäçèéêëíîïñóôöùúûü"
    return (F.when(c.rlike("[0-9]"), (byte % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(byte % 26 + 97)).when(c.rlike("[A-Z]"), F.char(byte % 26 + 65))
            .when(c.rlike(r"\p{IsLatin}"), F.substr(F.lit(accents), byte % len(accents) + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substr(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), byte % 27 + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsGreek}"), F.substr(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), byte % 24 + 1, F.lit(1)))
            .when(c.rlike(r"\p{L}"), F.substr(F.lit("的一是不了人我在有他这中大来上国"), byte % 16 + 1, F.lit(1)))
            .otherwise(c))


def _each(text: Column, fn) -> Column:
    """``fn(character, index)`` over a text."""
    chars = F.split(text, "(?!^)")
    return F.array_join(F.transform(chars, fn), "")


def _luhn(digits: Column) -> Column:
    """Sum by Luhn over a digit string whose last digit is the check digit."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substr(digits, i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - i) % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), part), F.lit(0), lambda a, b: a + b)


def _mod97(account: Column) -> Column:
    """An account number's remainder by 97: country and check digits behind the rest, letters as two digits."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(moved, r"(?!^)(?!\z)"), F.lit(0), lambda r, c: (r * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def _longer(attempt: int, letters: bool) -> Column:
    """Characters that a late draw adds to a core whose own length is crowded."""
    n = max(0, attempt - PLAIN_DRAWS + 1)
    if not n:
        return F.lit("")
    tail = F.substr(F.col("stream"), F.length("stream") - n + 1, F.lit(n))  # hex digits
    return F.translate(tail, "0123456789abcdef", "abcdefghijklmnop") if letters else F.translate(tail, "abcdef", "012345")


def _core(attempt: int) -> Column:
    """Surrogate of the canonical form, of the same length but for persons, addresses and late draws."""
    canonical, kind = F.col("canonical"), F.col("kind")
    plain = _each(canonical, lambda c, i: _char(c, i))
    more, more_digits = _longer(attempt, True), _longer(attempt, False)
    digits = F.concat(F.substr(canonical, F.lit(1), F.lit(1)), F.substr(plain, F.lit(2)))
    stem = F.substr(digits, F.lit(1), F.length(digits) - 1)
    stem = F.concat(stem, more_digits)
    card = F.concat(stem, ((10 - _luhn(F.concat(stem, F.lit("0"))) % 10) % 10).cast("string"))
    address = F.lit(None) if attempt >= PLAIN_DRAWS else F.concat_ws(".", *[(_byte(F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    if attempt >= PLAIN_DRAWS:  # a wider kind of address
        address = F.concat(F.lit("fd00:"), F.concat_ws(":", *[F.substr(F.col("stream"), F.lit(4 * i + 1), F.lit(4)) for i in range(4)]))
    host_end = F.regexp_extract(canonical, r"(\.[^.]*)$", 1)
    mail = F.concat(more, F.substr(plain, F.lit(1), F.length(plain) - F.length(host_end)), host_end)
    hexed = _each(canonical, lambda c, i: F.when(c.rlike("[0-9a-f]"), F.substr(F.col("stream"), i + 1, F.lit(1))).otherwise(_char(c, i)))
    secret = F.concat(F.when(canonical.rlike("^[0-9a-f]+$"), hexed).otherwise(
        F.concat(F.substr(canonical, F.lit(1), F.lit(4)), F.substr(plain, F.lit(5)))), more_digits)
    country, account = F.substr(canonical, F.lit(1), F.lit(2)), F.concat(F.substr(plain, F.lit(5)), more_digits)
    check = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    iban = F.concat(country, F.when(_mod97(canonical) == 1, check).otherwise(F.substr(plain, F.lit(3), F.lit(2))), account)
    given = F.lit(None).cast("string")
    for (g, s), names in NAMES.items():
        pick = F.element_at(F.array(*[F.lit(n) for n in names]), _byte(F.lit(0)) % len(names) + 1)
        given = F.when((F.col("gender") == g) & (F.col("script") == s), pick).otherwise(given)
    # a family name of the length of the last name, in its script, from the keyed characters at its place
    family = F.initcap(F.concat(F.regexp_extract(plain, r"([^ |]+)$", 1), more))
    person = F.when(canonical.rlike(r"\|[^|]* "), F.concat_ws(" ", given, family)).otherwise(family)
    return (F.when(kind == "card", card).when(kind == "ip", address).when(kind == "email", mail)
            .when(kind == "secret", secret).when(kind == "iban", iban).when(kind == "person", person)
            .when(kind == "phone", F.concat(digits, more_digits)).otherwise(F.concat(plain, more_digits)))


def cores(described_: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(kind, canonical, core): distinct cores, none equal to a real entity of its kind.

    Every draw past the first few is a character longer than the one before, so all entities find
    room however many there are.
    """
    real = stage(described_.select("kind", "canonical", "gender", "script").distinct(), "real")
    taken_by = F.when(F.col("kind") == "person", F.regexp_extract("canonical", r"([^|]*)$", 1)).otherwise(F.col("canonical"))
    known = real.select("kind", taken_by.alias("value")).distinct()
    todo, done, attempt = real, None, 0
    parts = int(described_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while done is None or not todo.isEmpty():
        # few bytes, much work: one small file would be one task
        drawn = todo.repartition(parts, "kind", "canonical").withColumn("stream", _stream(attempt, key)).withColumn("core", _core(attempt))
        value = F.when(F.col("kind") == "person", F.lower("core")).otherwise(F.col("core"))
        one = drawn.groupBy("kind", value.alias("value")).agg(F.min(F.struct("canonical", "core")).alias("w"))
        one = one.join(known, ["kind", "value"], "left_anti")
        if done is not None:
            one = one.join(done.select("kind", "value"), ["kind", "value"], "left_anti")
        won = stage(one.select("kind", "value", "w.canonical", "w.core"), "cores")
        done = won if done is None else stage(done.unionByName(won), "cores")
        todo = stage(todo.join(won.select("kind", "canonical"), ["kind", "canonical"], "left_anti"), "cores-todo")
        attempt += 1
    return done.select("kind", "canonical", "core")


def _laid_out() -> Column:
    """The core in the layout of the entity: separators and case as they were."""
    body, core = F.col("body"), F.col("core")
    n_digits, n_marks = F.length(F.regexp_replace(body, r"\D", "")), F.length(F.regexp_replace(body, " ", ""))
    digits_before = lambda i: F.length(F.regexp_replace(F.substr(body, F.lit(1), i), r"\D", ""))
    numbers = _each(body, lambda c, i: F.when(c.rlike("[0-9]"), F.substr(core, digits_before(i) + 1, F.lit(1))).otherwise(c))
    numbers = F.concat(numbers, F.substr(core, n_digits + 1))
    marks_before = lambda i: F.length(F.regexp_replace(F.substr(body, F.lit(1), i), " ", ""))
    spaced = _each(body, lambda c, i: F.when(c == " ", c).otherwise(F.substr(core, marks_before(i) + 1, F.lit(1))))
    spaced = F.concat(spaced, F.substr(core, n_marks + 1))
    cased = _each(body, lambda c, i: F.when(c.rlike(r"\p{Lu}"), F.upper(F.substr(core, i + 1, F.lit(1))))
                  .otherwise(F.substr(core, i + 1, F.lit(1))))
    cased = F.concat(cased, F.substr(core, F.length(body) + 1))
    title = F.substr(F.col("entity"), F.lit(1), F.length("entity") - F.length("body"))
    person = F.concat(title, F.when(body == F.upper(body), F.upper(core)).otherwise(core))
    return (F.when(F.col("kind").isin("card", "phone", "ssn"), numbers).when(F.col("kind") == "iban", spaced)
            .when(F.col("kind") == "ip", core).when(F.col("kind") == "person", person).otherwise(cased))


def surrogate_map(found: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(entity, kind, surrogate) of all distinct entities in ``found(entity)``; none for what is no entity after all."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # few bytes, much work: dealt out evenly, whatever their size
    known = stage(described(found.select("entity").distinct().repartition(parts)), "entities")
    return known.join(cores(known, key), ["kind", "canonical"]).select("entity", "kind", _laid_out().alias("surrogate"))


def replace(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """The documents with their entities replaced, all columns kept, and ``__kinds`` (array) added."""
    text, columns = F.col("text"), docs.columns
    rows = with_needs(docs).select("*", entities(text).alias("__hits"), F.monotonically_increasing_id().alias("__row"))
    rows = stage(rows, "documents")
    some, none = rows.where(F.size("__hits") > 0), rows.where(F.size("__hits") <= 0)
    found = some.select("__row", F.posexplode("__hits").alias("__at", "entity"))
    known = stage(surrogate_map(found, key), "surrogates")
    per_row = found.join(known, "entity").groupBy("__row").agg(
        F.map_from_entries(F.collect_list(F.struct("__at", "surrogate"))).alias("__new"),
        F.array_sort(F.collect_set("kind")).alias("__kinds"))
    joined = some.join(per_row, "__row", "left")
    gaps = _by_need(text, lambda p: F.split(text, p, -1), F.array(text))
    rebuilt = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(
        F.element_at(F.col("__new"), i), F.get(F.col("__hits"), i), F.lit("")))), "")
    new = F.when(F.col("__new").isNull(), text).otherwise(rebuilt)
    return joined.withColumn("text", new).select(*columns, "__kinds").unionByName(
        none.select(*columns, F.lit(None).cast("array<string>").alias("__kinds")))
