"""Surrogates against the same patterns in plain Python, and the cases that broke them before."""

import random

import regex
from pyspark.sql import functions as F

from roadsight.llm import surrogates


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, entity string, __at int")
    return {r.doc_id: r.text for r in surrogates.replace(docs).collect()}


def luhn(number):
    digits = [int(c) for c in reversed(number) if c.isdigit()]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def mod97(account):
    account = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def parts(text):
    """Gaps and entities of a text, by Python's engine."""
    hits = [m for m in regex.finditer(surrogates._any(*(n for n, _ in surrogates.TYPES)), text)]
    kind = lambda h: next((n for n, p in surrogates.TYPES[:-1] if regex.fullmatch(p, h)), "person")
    hits = [m for m in hits if kind(m.group()) != "card" or luhn(m.group())]
    edges = [0] + [x for m in hits for x in m.span()] + [len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])], [(kind(m.group()), m.group()) for m in hits]


def canonical(kind, entity):
    if kind in ("card", "phone", "ssn"):
        return kind, regex.sub(r"\D", "", entity)
    if kind == "iban":
        return kind, entity.replace(" ", "")
    if kind != "person":
        return kind, entity.lower()
    body = regex.sub(rf"^(?:{surrogates._TITLE})\.? ", "", entity)
    gender = "n"
    for g in "mf":
        if any(body.startswith(n + " ") for (gg, _), ns in surrogates.NAMES.items() if gg == g for n in ns):
            gender = g
    for g in "mf":
        if regex.match(rf"(?:{'|'.join(surrogates.TITLES[g])})\.? ", entity):
            gender = g
    return kind, gender + "|" + body.lower()


def make_entity(rng):
    word = lambda: rng.choice("ABCDEFGH") + "".join(rng.choice("aeioulmnr") for _ in range(rng.randrange(1, 9)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        stem = rng.choice("345") + digits(14)
        number = next(stem + c for c in "0123456789" if luhn(stem + c))
        return rng.choice([number, " ".join(number[i:i + 4] for i in range(0, 16, 4)), "-".join(number[i:i + 4] for i in range(0, 16, 4))])
    kinds = [lambda: f"{word()}.{word()}@{word().lower()}.example.{rng.choice(['com', 'org'])}", card,
             lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40, 64, 200]))),
             lambda: "sk-" + "".join(rng.choice("abcXYZ0189") for _ in range(rng.choice([20, 150]))),
             lambda: ".".join(str(rng.randrange(1, 255)) for _ in range(4)), lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
             lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"+49 30 {digits(7)}",
             lambda: f"{rng.choice(['Mr.', 'Mrs', 'Dr.', 'Herr', 'Madame'])} {word()}{word().lower()}",
             lambda: f"{rng.choice(['Anna', 'Peter', 'Robin'])} {word()}", lambda: f"contact {word()}x {word()}"]
    return rng.choice(kinds)()


def test_surrogates_equal_the_plain_search(spark):
    rng = random.Random(3)
    pool = [make_entity(rng) for _ in range(150)]
    texts = ["; ".join(rng.choice([rng.choice(pool), rng.choice(pool).upper() if rng.random() < 0.1 else "plain words here", "9999 1111"])
                       for _ in range(rng.randrange(0, 12))) for _ in range(200)]
    texts.append(" , ".join(pool) + " filler words" * 60_000 + " " + pool[0])   # a very long text
    got = run(spark, texts)
    forward, back = {}, {}
    real = {canonical(*e) for t in texts for e in parts(t)[1]}
    for i, text in enumerate(texts):
        gaps, hits = parts(text)
        new_ones, at = [], len(gaps[0])
        assert got[i].startswith(gaps[0])
        for gap in gaps[1:]:                                # all between entities is as it was
            end = got[i].index(gap, at) if gap else len(got[i])
            new_ones.append(got[i][at:end])
            at = end + len(gap)
        assert at == len(got[i]), (text[:300], got[i][:300])
        for (kind, entity), new in zip(hits, new_ones):
            key = canonical(kind, entity)
            assert new != entity
            if kind == "card":
                assert luhn(new)
            if kind in ("card", "phone", "ssn", "ip", "email"):
                core = canonical(kind, new)
                assert core not in real
            elif kind == "person":
                core = kind, regex.sub(rf"^(?:{surrogates._TITLE})\.? ", "", new).lower()
            else:
                core = kind, new.lower()
            assert forward.setdefault(key, core) == core    # coreference
            assert back.setdefault(core, key) == key        # distinctness


def test_nothing_leaks_by_length(spark):
    texts = ["key sk-" + "a1B2" * 40, "hex " + "0123456789" * 20, "call +49 30 1234567 today", "write to " + "c" * 90 + "@d.example",
             "to x@" + "b" * 70 + ".org", "please contact Jane Doe now", "signed by John Q. Public"]
    secrets = ["a1B2", "0123456789", "1234567", "cccc", "bbbb", "Jane", "Public"]
    got = run(spark, texts)
    for i, secret in enumerate(secrets):
        assert secret not in got[i] and got[i].split(" ")[0] == texts[i].split(" ")[0]


def test_crowded_names_get_longer_ones(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a.upper() + b for a in letters for b in letters]
    got = run(spark, [f"Mr. {n} came" for n in names])
    new = [got[i][4:-5] for i in range(len(names))]
    assert len(set(new)) == 676 and not {n.lower() for n in new} & {n.lower() for n in names}


def test_one_person_with_and_without_a_neutral_title(spark):
    got = run(spark, ["Dr. Anna Smith met Anna Smith.", "Mrs. Anna Smith, Prof. Anna Smith; Mr. Peter Smith"])
    one, two = regex.fullmatch(r"Dr\. (\w+ \w+) met (\w+ \w+)\.", got[0]).groups()
    assert one == two and one.split()[0] in surrogates.NAMES[("f", "latin")]
    three, four, five = regex.fullmatch(r"Mrs\. (\w+ \w+), Prof\. (\w+ \w+); Mr\. (\w+ \w+)", got[1]).groups()
    assert three == four == one and five != one and five.split()[0] in surrogates.NAMES[("m", "latin")]


def test_check_digits(spark):
    got = run(spark, ["DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "4111111111111111 is one, 4111111111111112 is none"])
    one, two = got[0].split(" and ")
    assert mod97(one) == 1 and mod97(two) == 1 and one[:2] == "DE" and two[:2] == "GB" and one != "DE89 3704 0044 0532 0130 00"
    card, rest = got[1].split(" is one, ")
    assert luhn(card) and card != "4111111111111111" and rest == "4111111111111112 is none"


def test_copies_without_id_and_clashing_columns(spark):
    text = "mail Anna.Smith@mail.example.com"
    docs = spark.createDataFrame([(None, text, "e", "k", 1)] * 50 + [(None, None, "e", "k", 1)], "doc_id long, text string, kind string, canonical string, __n int")
    out = surrogates.replace(docs)
    assert out.columns == [*docs.columns, "__kinds"]
    rows = out.where(F.col("text").isNotNull()).collect()
    assert len(rows) == 50 and len({r.text for r in rows}) == 1 and "Smith" not in rows[0].text
