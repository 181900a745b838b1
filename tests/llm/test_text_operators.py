"""Text operators against brute force, with null, empty, long, tied, repeated and clashing input."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadsight.llm import license_scan, mixing, ngram_join, packing, quality_fm, surrogates

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, block int, entity string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 0.5, "x", 1, "e") for i, t, s in rows], DOCS)


def make_texts(seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words, 30))
    texts = []
    for _ in range(25):
        base = list(rng.choice(words, int(rng.integers(3, 60))))
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 4))):
            copy = list(base)
            copy[int(rng.integers(len(copy)))] = "zz"
            texts.append(" ".join(copy))
    big = list(rng.choice(words, 80))
    for k in range(40):  # a group of near copies
        copy = list(big)
        copy[int(rng.integers(80))] = f"v{k}"
        texts.append(" ".join(copy))
    texts += [passage + f" tail{k} " + " ".join(rng.choice(words, 12)) for k in range(20)]
    texts += [texts[0], texts[0].upper(), "", None, " \t ", "one", "one", "one two", "ONE\ntwo", "\u00e9\u00c9 x"]
    return texts


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("limit,light", [(None, 32), (0, 3), (10 ** 9, 3)])
def test_ngram_join_is_exact(spark, limit, light):
    rows = list(enumerate(make_texts()))
    got = ngram_join.join(frame(spark, [(i, t, "s") for i, t in rows]), buckets=16, limit=limit, light=light)
    assert sorted(map(tuple, got.collect())) == brute_components(rows)


def test_ngram_join_edges(spark):
    text = " ".join(f"a{i}" for i in range(20))
    docs = frame(spark, [(3, text, "s"), (3, text, "s"), (None, text, "s"), (4, text + " b", None), (5, None, None)])
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect())
    assert got == [(-1, 16, 3), (3, 16, 3), (3, 16, 3), (4, 17, 3), (5, 0, 5)]
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [3, 5]
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_keep_one_goes_by_rows_and_not_by_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    rows = [(None, one, "s"), (None, one, "s"), (None, one + " z", "s"), (7, two, "s"), (8, two, "s"), (8, three, "s"),
            (8, None, "s"), (8, None, "s"), (None, "", "s"), (3, "q " + three.upper(), "s")]
    kept = ngram_join.keep_one(frame(spark, rows)).collect()
    texts = sorted((r.doc_id or -1, r.text or "") for r in kept)
    assert [t for t in texts if t[1][:1] == "a"] in ([(-1, one)], [(-1, one + " z")])
    assert [t for t in texts if t[1][:1] != "a"] == sorted([(7, two), (3, "q " + three.upper()), (8, ""), (8, ""), (-1, "")])
    bare = ngram_join.keep_one(frame(spark, [(None, two, "s")] * 4 + [(7, two, "s")])).collect()
    assert len([r for r in bare if r.doc_id == 7]) == 1 and len(bare) <= 2
    lone = ngram_join.keep_one(frame(spark, [(1, one, "s"), (2, one, "s"), (2, two, "s"), (2, three, "s")])).collect()
    assert sorted((r.doc_id, r.text) for r in lone) == [(1, one), (2, two), (2, three)]


def test_long_text_is_hashed_like_its_words(spark):
    from roadsight.llm.common import space_words
    text = ("x" * 700_000 + " " + "ab cd " * 200_000).encode()
    hasher = space_words()
    many, counts = hasher.texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    one, _ = hasher.texts(np.frombuffer(b"ab", np.uint8), np.array([0, 2]))
    assert counts[0] == 400_001 and (many[1::2] == one[0]).all()


def test_packing(spark):
    texts = [" ".join(f"word{i % 97}" for i in range(n)) for n in (0, 1, 50, 700, 3000, 5000, 900, 20, 20)] + [None]
    docs = frame(spark, [(i if i else None, t, None) for i, t in enumerate(texts)])
    rows = packing.pack_documents(docs, keep_ids=True).toPandas()
    assert rows["length"].max() <= 2048 and (rows["length"] > 0).all()
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 2048
    from tokenizers import Tokenizer
    import public_tokenizers
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t in enumerate(texts[1:], 1):
        own = rows[rows.doc_id == i].sort_values("piece")
        assert [x for ids in own.ids for x in ids] == whole.encode(t or "", add_special_tokens=False).ids + [0]
        assert (own["length"][1:] == 2048).all()
    assert packing.sequences(packing.pack_documents(docs, keep_ids=True)).count() == rows.sequence_id.nunique()
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packing_takes_added_tokens_as_the_tokenizer_does(spark):
    from tokenizers import Tokenizer
    import public_tokenizers
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|>a", "<|endoftext", "plain"]
    rows = packing.pack_documents(frame(spark, [(i, t, None) for i, t in enumerate(texts)]), keep_ids=True).toPandas().set_index("doc_id")
    assert list(rows.ids[0]) == [87, 220, 50256, 331, 0]
    for i, t in enumerate(texts):
        assert list(rows.ids[i]) == whole.encode(t, add_special_tokens=False).ids + [0]


def test_best_fit_takes_the_tightest_room():
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 101, 500))[::-1]
    sequence, offset = packing.best_fit_decreasing(lengths, 100)
    rooms = []
    for length, number, at in zip(lengths, sequence, offset):
        fits = [r for r in rooms if r >= length]
        if length == 100 or not fits:
            rooms.append(100)
            fits = [100]
        assert at == 100 - min(fits)
        rooms.remove(min(fits))
        rooms.append(min(fits) - length)


def test_mixing(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 40))) if i % 17 else None, f"s{int(rng.integers(5))}" if i % 11 else None)
            for i in range(400)] + [(7, "a b c", "s1")] * 30 + [(None, "a b", None)] * 3
    docs = frame(spark, rows)
    got = mixing.taken_words(docs).toPandas()
    again = mixing.taken_words(docs).toPandas()
    key = ["doc_id", "size", "taken", "target"]
    assert np.array_equal(got[key].sort_values(key).values.astype(float), again[key].sort_values(key).values.astype(float), equal_nan=True)
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    names = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, rest = set(names), {}, 1.5 * sum(sizes.values())
    while left:
        rate = rest / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * rate > 2 * sizes[s]]
        for s in over or left:
            target[s] = 2.0 * sizes[s] if over else weight[s] * rate
        rest -= sum(target[s] for s in over)
        left = left - set(over) if over else set()
    for s in names:
        one = got[(got.source_size == sizes[s]) & np.isclose(got.target, target[s])]
        assert len(one) and abs(one.taken.sum() - target[s]) <= 45
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)))).first()[0]
    assert words == got.taken.sum()
    assert mixing.taken_words(docs.limit(0)).count() == 0


def test_split_tree_deals_all_blocks_evenly(spark):
    quota = spark.createDataFrame([("a", 70), ("b", 7), (None, 23)], "source string, blocks long")
    got = mixing.split_tree(quota, 20).toPandas()
    assert got.assign(source=got.source.fillna("-")).groupby("source").blocks.sum().to_dict() == {"a": 70, "b": 7, "-": 23}
    assert set(got.groupby("shard").blocks.sum()) == {5}


def test_surrogates(spark):
    text = ("Anna.Smith@mail3.example.com and ANNA.SMITH@MAIL3.EXAMPLE.COM; Mr. John Miller met Mrs. Kowalski. "
            "4111-1111-1111-1111 or 4111 1111 1111 1111 at 10.2.3.4, +1 (017) 555-5036, 123-45-6789, "
            "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde, \u0413\u043e\u0441\u043f\u043e\u0436\u0430 \u0418\u0432\u0430\u043d\u043e\u0432\u0430.")
    rows = [(1, text, "s"), (1, text, "s"), (2, None, "s"), (3, "", "s"), (4, "plain text, nothing here 12", "s"), (None, "at 10.2.3.4", "s")]
    rows += [(10 + i, f"call +1 (200) 555-{i:04d} now", "s") for i in range(300)]
    docs = frame(spark, rows)
    out = surrogates.replace(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == [*docs.columns, "__kinds"] and out.count() == len(rows)
    assert got[2].text is None and got[3].text == "" and got[4].text == rows[4][1]
    new = got[1].text
    for secret in ("Smith", "SMITH", "Miller", "Kowalski", "4111", "10.2.3.4", "555-5036", "123-45", "2abc3ff", "\u0418\u0432\u0430\u043d\u043e\u0432\u0430"):
        assert secret not in new
    mail = re.findall(r"\S+@\S+?\.com", new, re.I)
    assert mail[0].upper() == mail[1].upper()
    one, two = re.search(r"(\d{4}-\d{4}-\d{4}-\d{4}) or (\d{4} \d{4} \d{4} \d{4})", new).groups()
    digits = [int(c) for c in one if c != "-"]
    assert one.replace("-", " ") == two and sum(sum(divmod(d * (2 - i % 2), 10)) for i, d in enumerate(digits)) % 10 == 0
    ip = re.search(r"at (\d+\.\d+\.\d+\.\d+)", new).group(1)
    assert got[None].text == f"at {ip}"
    phones = [re.search(r"\+\d \(\d{3}\) \d{3}-\d{4}", got[10 + i].text).group(0) for i in range(300)]
    assert len(set(phones)) == 300
    assert surrogates.replace(docs.limit(0)).count() == 0


def test_license_automaton_matches_brute_force():
    rng = np.random.default_rng(4)
    templates = [list(map(int, rng.integers(0, 4, 12))) for _ in range(3)]
    auto = license_scan.Automaton(templates)
    inside = {tuple(t[i:j]) for t in templates for i in range(12) for j in range(i, 13)}
    text = list(map(int, rng.integers(0, 5, 200)))
    for i, (_, size) in enumerate(auto.statistics(text), 1):
        want = next(k for k in range(i, -1, -1) if k == 0 or tuple(text[i - k:i]) in inside)
        assert size == want


def test_license_scan(spark):
    texts = ["x MIT License. mit-license", "Apache  LICENSE / General Public\nLicense", None, "", "---", "submit license",
             license_scan.TEMPLATES[0][1], "Licensed under CC BY-NC 4.0.", "permission is hereby"]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (5, 2, 1, 3, "mit")
    assert (got[1].n_base, got[1].base_labels) == (2, "apache,gpl")
    assert all(got[i].n_base == 0 and got[i].first_word is None and got[i].labels == "" for i in (2, 3, 4, 5, 8))
    assert (got[6].labels, got[6].base_labels, got[6].score) == ("mit", "", 1.0)
    assert got[7].labels == "cc-by-nc" and 0 <= got[8].score < 0.6
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_fm.train(docs, labels)
    joined = quality_fm.score(docs, model).join(labels, "doc_id").where("held_out")
    assert joined.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] >= 0.95
    edge = frame(spark, [(1, None, "s"), (1, "", "s"), (None, "some text", None)])
    rows = quality_fm.score(edge, model).collect()
    assert len(rows) == 3 and all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score
    assert quality_fm.keep_good(edge, model).columns == edge.columns
    none = quality_fm.train(docs, labels.limit(0))
    assert quality_fm.score(edge.limit(0), none).count() == 0


def test_quality_pair_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(5)
    model = quality_fm.Model(0.3, rng.standard_normal(6), rng.standard_normal((6, 3)))
    x = rng.standard_normal((4, 6))
    want = [0.3 + r @ model.linear + sum(model.factors[i] @ model.factors[j] * r[i] * r[j] for i in range(6) for j in range(i)) for r in x]
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(-np.array(want))))
