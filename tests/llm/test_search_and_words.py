"""Neighbours, alignment and spelling variants against plain versions, on small tables with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catloom.llm import alignment, neighbours, packing, spelling
from tests.llm.test_operators import docs, empty, rows  # noqa: F401


@pytest.fixture(scope="module")
def vectors():
    """Ids and vectors: clusters, a vector that a third of all rows share, unequal norms, and rows that take no part."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 24))
    data = [(i, (centres[i % 12] + 0.4 * rng.standard_normal(24)).tolist()) for i in range(600)]
    data += [(600 + i, centres[0].tolist()) for i in range(300)]
    data += [(1000 + i, (3 * centres[i] * (1 + i)).tolist()) for i in range(6)]
    data += [(20, data[20][1]), (40, data[41][1]), (41, data[41][1])]  # a repeated row; ids with several vectors or one vector
    data += [(None, data[3][1]), (2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] + [1.0] * 23), (2004, [float("inf")] * 24), (2005, [None] + [1.0] * 23)]
    return data + [(2020, [1.0, 2.0]), (2021, [2.0, 1.0]), (2040, [-0.0, 1.0]), (2060, [0.0, 1.0])]  # another length


def nearest(data, k):
    """Every query's ``(vec_id, score)``, by comparing with all."""
    of = defaultdict(list)
    for i, v in data:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            of[i].append(np.array(v))
    found = {}
    for q in of:
        if q % 20 == 0:
            scores = {}
            for c in of:
                both = [float(a @ b) for a in of[q] for b in of[c] if len(a) == len(b)]
                if c != q and both:
                    scores[c] = max(both)
            found[q] = sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return found


def test_neighbours(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    for name in ("key", "shard", "vector", "score", "rank", "dim", "asks", "n"):
        df = df.withColumn(name, F.lit("other"))
    search = lambda recall: neighbours.nearest(df.repartition(3), lambda i: i % 20 == 0, k=5, recall=recall, shard_rows=200).collect()
    wanted, met = nearest(vectors, 5), 0
    for recall in (1.1, 0.9):  # 1.1: no query may stop before the root
        out = defaultdict(list)
        for r in search(recall):
            out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
        assert set(out) == {q for q, found in wanted.items() if found}
        for q, found in out.items():
            found.sort()
            assert [rank for rank, _, _ in found] == list(range(1, len(wanted[q]) + 1))
            if recall > 1:
                assert [v for _, v, _ in found] == [v for v, _ in wanted[q]]
                assert np.allclose([s for _, _, s in found], [s for _, s in wanted[q]], rtol=0, atol=1e-9)
            met += len({v for _, v, _ in found} & {v for v, _ in wanted[q]})
    assert met >= 1.9 * sum(map(len, wanted.values()))
    assert neighbours.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_forest_leaves_far_subtrees_alone():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((64, 32))
    points = np.repeat(centres, 64, axis=0) + 0.05 * rng.standard_normal((4096, 32))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    forest, scored = neighbours.Forest(points, 1.0), []
    before = forest._score
    forest._score = lambda q, a, b, order, keep: scored.append(int((b - a).sum())) or before(q, a, b, order, keep)
    queries = points[::40]
    _, found = forest.search(queries, 10, 10, 40, 0.9)
    truth = np.argsort(-(queries @ points.T), axis=1, kind="stable")[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, truth)]) >= 0.9
    assert sum(scored) < len(queries) * len(points) / 4


def plain_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_model.encode_special_tokens = True
    byte = {chr(letter): b for b, letter in packing.BYTE_LETTERS.items()}
    a_bytes = lambda i: bytes(byte.get(c, ord(c)) for c in a_model.id_to_token(i))
    b_bytes = lambda i: bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p := b_model.id_to_piece(i)) else p.replace("▁", " ").encode()
    made, counts = [], Counter()
    for i, text, *_ in rows:
        a, b = (a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)) if text else ([], [])
        sides, whole = [[(x, f(x)) for x in ids] for ids, f in ((a, a_bytes), (b, b_bytes))], (" " + (text or "")).encode()
        groups = []
        if text and all(b"".join(y for _, y in side) == whole for side in sides):
            ends = [np.cumsum([len(y) for _, y in side]).tolist() for side in sides]
            at = [0, 0]
            for end in sorted(set(ends[0]) & set(ends[1])):
                stop = [e.index(end) + 1 for e in ends]
                groups.append(tuple([x for x, _ in side[p:q]] for side, p, q in zip(sides, at, stop)))
                at = stop
        else:
            a, b = [], []
        links = [(x, y) for left, right in groups for x in left for y in right]
        counts.update(set(links))
        made.append((i, len(a), len(b), groups, links))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    spell = lambda groups: ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
    return [
        (i, a, b, len(g), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(spell(g).encode()).hexdigest() if g else "")
        for i, a, b, g, links in made
    ]


def test_alignment(spark, docs, rows, empty, monkeypatch):  # noqa: F811
    more = [(90, "a <|endoftext|> b </s> <unk> <0x41>"), (91, "▁x y"), (92, "日本語 😀😀 日本語"), (93, " \n\n  lead"), (94, "x" * 500), (95, "the the the"), (95, "the the the")]
    short = [r for r in rows if len(r[1] or "") < 3000]
    df = docs.filter("text is null or length(text) < 3000").select("doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    df = df.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    wanted = sorted(map(str, plain_alignment([*short, *more])))
    for hot in (1 << 16, 0.5):  # with and without groups that are broadcast
        monkeypatch.setattr(alignment, "HOT", hot)
        assert sorted(str(tuple(r)) for r in alignment.align(df).collect()) == wanted
    assert alignment.align(empty).count() == 0


def test_one_key_for_two_groups_is_an_error(spark):
    rows = spark.createDataFrame([("group", 1, [1], [2], 1), ("group", 1, [1], [3], 1)], "kind string, key long, a_ids array<int>, b_ids array<int>, docs long")
    with pytest.raises(Exception, match="another seed"):
        alignment.dictionary(rows).collect()


def plain_variants(rows, min_length, min_count, ratio):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    cut = {w: [w[:i] + w[i + 1 :] for i in range(len(w))] for w in words}
    near = lambda v, w: v in cut[w] or w in cut[v] or (len(v) == len(w) and sum(a != b for a, b in zip(v, w)) == 1)
    form, count = {}, {}
    for w in words:
        found = sorted((v for v in words if v != w and abs(len(v) - len(w)) < 2 and near(v, w)), key=lambda v: (-words[v], v))
        count[w], form[w] = len(found), found[0] if found and words[found[0]] >= ratio * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, n, count[w], form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def test_spelling(spark, docs, rows, empty):  # noqa: F811
    rng = random.Random(6)
    texts = [(i, t) for i, t, *_ in rows]
    base = ["aaabbb", "garden", "window", "écoleé", "abababab", "q" * 3000]
    for k in range(300):
        w = rng.choice(base)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abéÉ") + w[i:], w[:i] + rng.choice("abG") + w[i + 1 :]])
        texts += [(1000 + k, f"{w}-{w.upper()} {w}")] * rng.choice([1, 1, 2, 5, 20])
    texts += [(2000, "lantern " * 90 + "lanterna " * 20 + "lanternab " * 4)]
    df = docs.select("doc_id", "text", "n", "key").unionByName(spark.createDataFrame(texts[len(rows) :], "doc_id long, text string"), allowMissingColumns=True).withColumn("word", F.lit("other"))
    out = spelling.variants(df.repartition(3), min_count=3, ratio=3).select("word", "n", "n_near", "form", "form_n", "root").collect()
    wanted = plain_variants(texts, 6, 3, 3)
    assert {tuple(r) for r in out} == wanted and len(out) == len(wanted)
    assert sum(form is not None for *_, form, _, _ in wanted) > 3 and any(form and root != form for *_, form, _, root in wanted)
    assert spelling.variants(empty).count() == 0


def test_spelling_survives_equal_hashes(spark, monkeypatch):
    """Keys that collide are parted by the strings."""
    df = spark.createDataFrame([(i, w) for i, w in enumerate("garden gardes window gardens winter arden".split() * 3)], "doc_id long, text string")
    keys = spelling.deletion_keys
    words = spark.createDataFrame([("garden", 9), ("gardes", 3), ("window", 3), ("gardens", 4), ("winter", 3), ("wxndow", 1)], "word string, n long")
    monkeypatch.setattr(spelling, "deletion_keys", lambda w: (keys(w)[0] & 1, *keys(w)[1:]))
    spark.sparkContext.setLogLevel("OFF")
    found = {r["word"]: (r["n_near"], r["best"]["word"]) for r in spelling.near_words(words).collect()}
    assert found == {"garden": (2, "gardens"), "gardes": (2, "garden"), "gardens": (2, "garden"), "window": (1, "wxndow"), "wxndow": (1, "window")}
    assert df.count() == 18
