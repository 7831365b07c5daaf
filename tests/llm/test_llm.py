"""Every operator on small tables: edge rows, brute force, round trips and held-out accuracy."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from skillmill.llm import (
    ann_partitions, bin_slack, edit_tokens, line_windows, ngram_join, queries, sp_bpe, surrogates, toxicity, va_search,
)
from skillmill.llm.common import components, ship, stored, table

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
RANKS, JSON = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("tiktoken", "json"))

EDGE = [
    (1, "one two three four five six seven\nx\ny", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "one two three four five six seven\nx\ny", "en", "a", 1),
    (4, "long " * 30_000 + "<|endoftext|> é漢\t 🙂  end \n", "en", "a", 1),
    (5, "one two three four five six seven\nx\ny", "en", "a", 1),
    (5, "one two three four five six seven\nx\ny", "en", "a", 1),
    (6, "\n\n\n\n\n", "en", "a", 5),
    (7, "Hi", "en", "a", 2),
]


@pytest.fixture(scope="module")
def session(spark):
    return ship(spark)


@pytest.fixture(scope="module")
def edge(session):
    return session.createDataFrame(EDGE, DOC)


@pytest.fixture(scope="module")
def empty(session):
    return session.createDataFrame([], DOC)


def texts_of(session):
    return {r.doc_id: r.text for r in table(session, SF, "documents").select("doc_id", "text").collect()}


def test_names_of_work_columns_in_the_input(session):
    names = "doc_id long, text string, __k1 int, __filled int, __starts string, __lines int, _doc int, __doc int"
    rows = [(1, "Mr John Smith\na\nb\nc", 1, 2, "s", 3, 4, 5), (2, "x\na\nb\nc", 1, 2, "s", 3, 4, 5)]
    docs = session.createDataFrame(rows, names)
    found = surrogates.with_surrogates(docs, "k")
    assert found.columns == [*docs.columns, "n_entities"]
    assert {tuple(r)[2:] for r in found.collect()} == {(1, 2, "s", 3, 4, 5, 1), (1, 2, "s", 3, 4, 5, 0)}
    found = line_windows.drop_repeated_windows(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    assert {tuple(r)[1:] for r in found.collect()} == {(rows[0][1], 1, 2, "s", 3, 4, 5, 4, 0), ("x", 1, 2, "s", 3, 4, 5, 4, 3)}


def test_more_values_than_a_small_range_has(session):
    """40,000 addresses of a range of 65,024, none of which may stand for one of them, and most of the numbers of four digits."""
    hosts = [f"192.168.{i // 250}.{i % 250 + 1}" for i in range(40_000)]
    phones = [f"+1 555 {i:04d}" for i in range(0, 10_000, 2)]
    docs = session.createDataFrame(list(enumerate([*hosts, *phones])), "doc_id long, text string")
    found = {r.doc_id: r.text for r in surrogates.with_surrogates(docs, "k").collect()}
    new = [found[i] for i in range(len(hosts))]
    assert len(set(new)) == len(hosts) and not set(new) & set(hosts)
    assert all(re.fullmatch(r"\d{1,3}(?:\.\d{1,3}){3}", x) for x in new)
    numbers = [found[len(hosts) + i] for i in range(len(phones))]
    assert len(set(numbers)) == len(phones) and not set(numbers) & set(phones)


def test_rounds_of_components_take_few_tasks(session):
    """Tables of a few numbers a row are not dealt over all shuffle partitions again and again."""
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [session.conf.get(n) for n in names]
    context = session.sparkContext
    pairs = session.createDataFrame([(i % 3, i) for i in range(3, 60)], "u long, v long").coalesce(1)
    try:
        for n, value in zip(names, ["200", "false"], strict=True):
            session.conf.set(n, value)
        context.setJobGroup("few tasks", "")
        found = {r.node: r.component for r in components(pairs).collect()}
    finally:
        for n, value in zip(names, before, strict=True):
            session.conf.set(n, value)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found == {i: i % 3 for i in range(60)}
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few tasks") for s in tracker.getJobInfo(j).stageIds}
    assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) <= 25


def test_components_are_those_of_a_search(session):
    random.seed(2)
    pairs = [(random.randint(0, 60), random.randint(0, 60)) for _ in range(45)]
    found = {r.node: r.component for r in components(session.createDataFrame(pairs, "u long, v long")).collect()}
    least = {n: n for p in pairs for n in p}
    for _ in least:
        for u, v in pairs:
            least[u] = least[v] = min(least[u], least[v])
    assert {n: c for n, c in found.items()} == {n: least[n] for n in found}
    assert {n for u, v in pairs if u != v for n in (u, v)} == set(found)


# --- surrogates ---------------------------------------------------------------------


def test_surrogates(session, edge, empty):
    text = (
        "Mrs. Ada Bell, +1 (976) 555-6291, +1 976 555 6291, Herr Bell, a.b.12@mail.example.com, 10.0.0.1, 226.203.165.104, "
        'card 4041-8949-7460-8795 or 4041894974608795, token = "40d78a45c418324758e099eb7cb89bc0f5fa9f62", г-жа Анна Петрова'
    )
    rows = [(1, text, 9), (2, "again a.b.12@mail.example.com and 226.203.165.104, not 4.0.", 9), (3, "clean 12 text, v 3.", 9), (4, None, 9)]
    found = {r.doc_id: r for r in surrogates.with_surrogates(session.createDataFrame(rows, "doc_id long, text string, pos int"), "k").collect()}
    new = found[1].text
    for old in ("Ada", "Bell", "976", "6291", "a.b.12@", "226.203", "4041-", "40d78a", "Анна", "Петрова"):
        assert old not in new
    name, phones = re.match(r"Mrs\. (\w+ (\w+)), \+1 \((\d{3})\) (\d{3}-\d{4}), ", new), re.findall(r"\+1 \d{3} \d{3} \d{4}", new)
    assert name[1].split()[0] in surrogates.GIVEN["f", "latin"] and f"Herr {name[2]}," in new
    assert re.sub(r"\D", "", phones[0]) == "1" + name[3] + name[4].replace("-", "")
    assert re.search(r", 10\.\d+\.\d+\.\d+, ", new)
    cards = re.search(r"card (4\d{3}-\d{4}-\d{4}-\d{4}) or (4\d{15}),", new)
    assert cards[1].replace("-", "") == cards[2]
    assert re.search(r'token = "[0-9a-f]{40}"', new) and re.search(r"г-жа \p{L}".replace(r"\p{L}", "[А-я]"), new)
    mail = re.search(r"[a-z]\.[a-z]\.\d\d@[a-z]+\.[a-z]+\.com", new)[0]
    assert found[2].text.startswith(f"again {mail} and ")
    assert found[3].text == "clean 12 text, v 3." and found[3].n_entities == 0 and found[3].pos == 9
    assert found[4].text is None
    assert Counter(r.text for r in surrogates.with_surrogates(edge, "k").collect()) == Counter(r[1] for r in EDGE)
    assert surrogates.with_surrogates(empty, "k").count() == 0


def test_surrogates_are_distinct_and_new(session):
    values = [f"10.0.{i % 256}.{i // 256 + 1}" for i in range(400)] + [f"x{i}@a{i % 7}.example" for i in range(300)]
    df = session.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    new = [r.text for r in surrogates.with_surrogates(df, "k").collect()]
    assert len(set(new)) == len(values) and not set(new) & set(values)


def test_personal_data_in_other_forms(session):
    held = [
        "555-123-4567", "1-555-123-4567", "555.123.4567", "555 123 4567", "030 1234567", "089/1234567", "01 23 45 67 89", "020 7946 0958",
        "2001:db8::8a2e:370:7334", "2001:0db8:0000:0000:0000:8a2e:0370:7334", "fe80::1", "371449635398431", "3714 496353 98431",
    ]
    secrets = ["PASSWORD=Sommerregen", "Password: Sommerregen", "API_KEY=Sommerregen", 'Token = "Sommerregen"', '"password": "Sommerregen"']
    clean = [
        "on 01-02-2024 or 01.02.2024, 01/02/2024 and 2024-01-02", "at 12:30:45 std::vector Add::bad", "1.5.3 and 10 20 30, 1,555,123", "ISBN 0-306-40615-2",
        "the PASSWORD is lost", "order 12345678901234567890", "Tokens: a, b", "05:12:44::x", "100 200 300 400",
    ]
    texts = [*[f"so {x}, then" for x in held], *secrets, *clean]
    found = {r.doc_id: r for r in surrogates.with_surrogates(session.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()}
    for i, x in enumerate(held):
        assert x not in found[i].text and found[i].n_entities == 1, (x, found[i].text)
        if ":" not in x:
            assert re.sub(r"\d", "0", found[i].text) == re.sub(r"\d", "0", texts[i])
    assert found[8].text == found[9].text and found[8].text.startswith("so 2001:")
    assert re.sub(r"\D", "", found[11].text) == re.sub(r"\D", "", found[12].text)
    for i, x in enumerate(secrets, len(held)):
        assert "Sommerregen" not in found[i].text and found[i].n_entities == 1, found[i].text
    for i, x in enumerate(clean, len(held) + len(secrets)):
        assert found[i].text == x, (x, found[i].text)


def test_surnames_and_mail_hosts_are_distinct_wherever_they_stand(session):
    syllables = surrogates.SYLLABLES["latin"]
    names = [f"{a}{b}{c}".capitalize() for a in syllables[:20] for b in syllables[:20] for c in syllables[:7]]  # forms of surrogates
    hosts = [f"{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    rows = [(i, f"Mr {n}") for i, n in enumerate(names)] + [(10_000 + i, f"Mr John {n}") for i, n in enumerate(names)]
    rows += [(20_000 + i, f"me@{h}.org") for i, h in enumerate(hosts)]
    found = {r.doc_id: r.text for r in surrogates.with_surrogates(session.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    lone = [found[i].removeprefix("Mr ") for i in range(len(names))]
    full = [found[10_000 + i].removeprefix("Mr ").split(" ") for i in range(len(names))]
    assert len(set(lone)) == len(names) and not set(lone) & set(names) and [f[-1] for f in full] == lone
    assert all(len(f) == 2 for f in full) and not any("-" in n for n in lone)
    new = [found[20_000 + i].split("@")[1].removesuffix(".org") for i in range(len(hosts))]
    assert len(set(new)) == len(hosts) and not set(new) & set(hosts)


# --- searches -----------------------------------------------------------------------


def vectors(session, bad=True):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.standard_normal(8)], 1) for i in range(300)]
    rows += [(300 + i, rows[7][1], 1) for i in range(40)]  # copies of one vector
    if bad:
        rows += [(400, None, 1), (401, [float("nan")] * 8, 1), (402, [0.0] * 8, 1), (None, [1.0] * 8, 1), (403, [None] * 8, 1), (420, [float("inf")] * 8, 1)]
    return rows, session.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


def brute(rows, every, k, whole):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    usable = [(i, np.floor(256 * v) if whole else v) for i, v in usable if whole or v.any()]
    out = {}
    for i, q in usable:
        if i % every == 0:
            out[i] = sorted((-float(q @ v), j) for j, v in usable if j != i)[:k]
    return out


def test_va_search_is_exact(session):
    rows, df = vectors(session)
    found = defaultdict(list)
    for r in va_search.search(df, df.where("vec_id % 20 = 0"), 5).collect():
        found[r.query_id].append((r["rank"], -float(r.score), r.vec_id))
    expected = brute(rows, 20, 5, True)
    assert {q: [x[1:] for x in sorted(v)] for q, v in found.items()} == expected
    assert va_search.search(df.where("vec_id < 3"), df.where("vec_id = 0"), 5).count() == 2
    assert va_search.search(df.limit(0), df.limit(0), 5).count() == 0


def test_va_search_broadcasts_neither_vectors_nor_blocks(session, monkeypatch):
    """The copies of the queries for the slices are many times the size of their file, by which Spark would choose."""
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(va_search, "stored", kept)
    _, df = vectors(session)
    assert va_search.search(df, df.where("vec_id % 20 = 0"), 5).count() == 5 * 17
    assert len(plans) >= 3 and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("bits", [6, 10])
def test_va_search_over_several_slices_and_groups(session, monkeypatch, bits):
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((40, 6))
    values = np.float32(np.concatenate([rng.standard_normal((2_400, 6)), centres[rng.integers(0, 40, 2_400)] + 0.01 * rng.standard_normal((2_400, 6))]))
    df = session.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<float>").repartition(8)
    monkeypatch.setattr(va_search, "cuts", lambda *_: (5, 3))
    found = defaultdict(list)
    for r in va_search.search(df, df.where("vec_id % 2 = 0"), 5, bits=bits).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    whole = np.floor(256 * values.astype(float))
    for q in range(0, len(whole), 2):
        score = whole @ whole[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(whole)), -score))[:5]
        assert sorted(found[q]) == [(n, j, score[j]) for n, j in enumerate(best, 1)]


def test_slices_and_groups_follow_the_bytes():
    for vectors_, queries_, parts in ((0, 0, 24), (500, 10, 24), (50_000, 1_000, 24), (615_384, 12_308, 24), (615_384, 12_308, 4_000), (10**8, 2 * 10**6, 24), (500, 10**7, 24)):
        slices, groups = va_search.cuts(vectors_, queries_, 88, 536, parts)
        assert slices >= 1 and groups >= 1
        assert 88 * vectors_ <= va_search.MOST_FILE * slices and 536 * queries_ <= va_search.MOST_ASKED * groups
        # What is copied is some times the tables, not a copy of the queries for each of many partitions.
        if max(slices * groups, parts) <= 24:
            assert 88 * vectors_ * groups + 536 * queries_ * slices <= 2 * 24**0.5 * (88 * vectors_ + 536 * queries_)


@pytest.mark.parametrize("most, kind", [(100, "smallint"), (10**6, "int"), (3 * 10**9, "double")])
def test_va_search_of_large_numbers(session, most, kind):
    rows = [(i, [float((i * 37 % 101 - 50) * most / 50), float(i * i % 17)]) for i in range(101)]
    df = session.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert va_search.narrowest(*va_search.grid(df.select(F.col("embedding").alias("v")), 6), 6) == kind
    found = defaultdict(list)
    for r in va_search.search(df, df.where("vec_id % 10 = 0"), 5, scale=1.0).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    whole = [[math.floor(x) for x in v] for _, v in rows]
    for q in range(0, 101, 10):
        best = sorted((-sum(int(float(a) * b) for a, b in zip(whole[q], w, strict=True)), i) for i, w in enumerate(whole) if i != q)[:5]
        assert sorted(found[q]) == [(n, i, -score) for n, (score, i) in enumerate(best, 1)]


def test_the_highest_products_of_blocks():
    rng = np.random.default_rng(13)
    highest, all_keys, all_scores = va_search.Highest(7, 4), [], []
    for size in (2, 1, 30, 5):
        keys, score = rng.integers(0, 10**9, (size, 2)), rng.standard_normal((7, size))
        highest.add(keys, score)
        all_keys, all_scores = [*all_keys, *keys], [*all_scores, *score.T]
        best = np.argsort(-np.array(all_scores).T, axis=1)[:, :4]
        for i, places in enumerate(best):
            held = [(s, *k) for s, k in zip(highest.scores[i], highest.keys[i], strict=True) if s > -np.inf]
            assert sorted(held) == sorted((all_scores[j][i], *all_keys[j]) for j in places)


def test_learned_partitions_find_most(session):
    rows, df = vectors(session)
    found = defaultdict(list)
    for r in ann_partitions.search(df, df.where("vec_id % 20 = 0"), 10, parts=8).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    expected = brute(rows, 20, 10, False)
    assert set(found) == set(expected) and all(len(v) == 10 for v in found.values())
    hits = sum(len({x[1] for x in found[q]} & {j for _, j in expected[q]}) for q in expected)
    assert hits >= 0.9 * 10 * len(expected)
    assert ann_partitions.search(df.limit(0), df.limit(0), 5).count() == 0


# --- classifiers --------------------------------------------------------------------


def accuracy(session, query, label):
    labels = {r.doc_id: r[label] for r in table(session, "/root/testdata/sf0.01", "labels").collect()}
    rows = [r for r in query(session, "/root/testdata/sf0.01").collect()]
    assert len(rows) == table(session, "/root/testdata/sf0.01", "documents").count()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    return np.mean([p == y for p, y in held])


def test_quality_and_toxicity_on_held_out_rows(session):
    assert accuracy(session, queries.op3_zstd_quality, "quality") >= 0.9
    assert accuracy(session, queries.op10_clause_grammar, "toxic") >= 0.9


def test_the_grammar_reads_clauses():
    g = toxicity.Grammar({"fool": 4.0})
    plain, targeted, negated, said = (g.clauses(t) for t in ("a fool came", "you are a fool", "is not a fool", 'she said that fool left'))
    assert negated[0] < plain[0] < targeted[0] and said[0] < plain[0]
    assert g.clauses("kill the lights") == [] and g.clauses("they will kill") != []
    assert g.clauses(None) == [] and g.clauses("") == [] and len(g.clauses("F00L! fool.\nfool")) == 3


def test_a_threat_counts_with_a_target_before_or_after_it():
    g = toxicity.Grammar({"idiot": 4.0})
    for text in ("I will kill you", "I will kill every last one of you tonight", "she kills him", "they killed her", "killing you\nno more"):
        assert len(g.clauses(text)) == 1, text
    for text in ("I will kill the lights. You may go", "kill it\nyou go", "you, who came by the old road, kill time", "hurt"):
        assert g.clauses(text) == [], text
    once, twice, negated = (g.clauses(t)[0] for t in ("I will kill you", "I will kill and burn you", "I will not kill you"))
    assert negated < once < twice
    assert g.clauses("the idiot may kill time") == g.clauses("the idiot came")


def test_words_are_parted_as_in_training():
    g = toxicity.Grammar({"idiot": 4.0})
    expected = g.clauses("you idiot")
    for space in ("\t", "\u00a0", "\r", "\u2003", "  ", "\u3000"):
        assert g.clauses(f"you{space}idiot") == expected and expected
    assert [w for w in toxicity.words_of("a\tb\nc \u00a0d") if w != "\n"] == "a\tb\nc \u00a0d".split()


def test_classifiers_without_labels(session, edge, empty):
    none = session.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int")
    assert {r.score < 0.01 for r in toxicity.toxicity(edge, none, F.lit(True)).collect()} == {True}
    assert toxicity.reject_toxic(edge, none, F.lit(True)).count() == len(EDGE)
    assert toxicity.toxicity(empty, none, F.lit(True)).count() == 0


# --- tokens -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_sentencepiece_encodes_as_the_ranks_do(session, edge, empty, reference):
    docs = edge.union(table(session, SF, "documents"))
    texts = [r.text or "" for r in docs.collect()]
    found = Counter((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sp_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect())
    ids = [np.array(reference.encode_ordinary(t), dtype="<u4") for t in texts]
    sha = [hashlib.sha256(x).hexdigest() for t, i in zip(texts, ids) for x in (i.tobytes(), t.encode())]
    assert found == Counter(zip(map(len, ids), sha[::2], sha[1::2]))
    assert sp_bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_edits_leave_the_counts_of_the_edited_text(session, edge, empty, reference):
    docs = edge.union(table(session, SF, "documents"))
    rows = edit_tokens.counts(docs, queries.derived_edits(), RANKS, public_tokenizers.PATTERN).collect()
    plain = docs.select("doc_id", "text", queries.derived_edits().alias("edits")).collect()
    expected = Counter()
    for r in plain:
        text = r.text or ""
        before = len(reference.encode_ordinary(text))
        for e in r.edits or []:
            start = min(e.start, len(text))
            text = text[:start] + e.replacement + text[max(start, min(e.stop, len(text))) :]
        expected[r.doc_id, before, len(reference.encode_ordinary(text)), len(text)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_tokens_after, r.n_chars_after) for r in rows) == expected
    own = edit_tokens.with_edits(edge, edge.sparkSession.createDataFrame([(7, 1, 0, 1, "W"), (7, 2, 2, 2, "!")], "doc_id long, edit_no int, start long, stop long, replacement string"))
    last = {r.doc_id: r for r in edit_tokens.counts(own, F.col("edits"), RANKS, public_tokenizers.PATTERN).collect()}
    assert last[7].n_chars_after == 3 and last[7].n_tokens_after == len(reference.encode_ordinary("Wi!")) and last[1].n_edits == 0
    assert edit_tokens.counts(empty, queries.derived_edits(), RANKS, public_tokenizers.PATTERN).count() == 0


def test_packing_holds_every_token_once(session, edge, empty):
    docs = edge.union(table(session, SF, "documents"))
    rows = bin_slack.packed(docs, JSON).collect()
    tokenizer = Tokenizer.from_file(JSON)
    expected = Counter()
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        expected.update((r.doc_id, p, s, n, c) for p, s, n, c in bin_slack.cut(ids, 1024))
        assert sum(n for _, _, n, _ in bin_slack.cut(ids, 1024)) * 4 == len(ids)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    assert all(r.ids_crc32 <= 0xFFFFFFFF for r in rows)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(r.length for r in rows) // 1024)
    assert len(bins) <= least + max(2, least // 100)
    assert bin_slack.packed(empty, JSON).count() == 0


# --- near copies and lines ----------------------------------------------------------


def jaccard_components(rows, size, percent):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for doc, text in rows:
        words = (text or "").encode().translate(lower).split()
        sets.append((doc, {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()))
    least = {d: d for d, _ in sets if d is not None}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((root(a), root(b)))
                least[v] = u
    return Counter((d, len(s), None if d is None else root(d)) for d, s in sets)


def test_near_components(session, edge, empty):
    random.seed(6)
    base = [f"w{random.randint(0, 500)}" for _ in range(120)]
    near = []
    for i in range(90):  # a group larger than a leaf, with links near the threshold
        words = list(base)
        for _ in range(random.randint(0, 5)):
            words[random.randrange(len(words))] = f"n{random.randint(0, 10**6)}"
        near.append((1000 + i, " ".join(words), "en", "hot", 1))
    short = [(2000 + i, " ".join(random.choice("abc") for _ in range(random.randint(1, 14))), "en", "s", 1) for i in range(120)]
    docs = session.createDataFrame([*EDGE, *near, *short], DOC)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_components(docs).collect())
    assert found == jaccard_components([(r[0], r[1]) for r in [*EDGE, *near, *short]], 4, 85)
    kept = {r.doc_id for r in ngram_join.keep_one(docs).collect()}
    assert kept == {c for _, _, c in found}
    assert ngram_join.near_components(empty).count() == 0


def test_trees_of_many_leaves(session, monkeypatch):
    """Several groups of near copies around one passage, in leaves of a few points, some of them of one component."""
    for name, value in {"LEAF": 8, "WIDE": 16, "ROUNDS": 1}.items():
        monkeypatch.setattr(ngram_join, name, value)
    random.seed(12)
    shared, rows = [f"s{i}" for i in range(90)], []
    for group in range(6):
        base = [*shared, *[f"g{group}x{i}" for i in range(14)]]
        for i in range(20):
            words = list(base)
            for _ in range(random.randint(0, 3)):
                words[random.randrange(len(words))] = f"n{random.randint(0, 10**6)}"
            rows.append((100 * group + i, " ".join(words)))
    docs = session.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOC)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_components(docs).collect())
    assert found == jaccard_components(rows, 4, 85)


def test_a_row_without_an_id_takes_no_place_in_its_block():
    words = [f"w{i}" for i in range(80)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    block = pa.RecordBatch.from_pydict({"doc_id": pa.array([None, 1, 2], pa.int64()), "text": [text, text, near]})
    (found,) = ngram_join.tree_rows(ngram_join.Shape(85), 4, 8)(iter([block]))
    members = [np.frombuffer(r["ids"], np.int64) for r in found.to_pylist() if r["kind"] == "members"]
    assert set(np.concatenate(members).tolist()) == {1, 2}


def test_copies_of_other_blocks_share_no_key():
    """Keys name sets, so copies that lie in several blocks hold a key once; what near copies share says how many do."""
    words = [f"w{i}" for i in range(80)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    texts = [[(1, text), (2, text)], [(3, text)], [(4, text), (None, near)]]

    def shared(blocks):
        batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in b], pa.int64()), "text": [t for _, t in b]}) for b in blocks]
        dealt = ngram_join.tree_rows(ngram_join.Shape(85), 4, 8, by_set=True)(iter(batches))
        found = [r for b in ngram_join.shared_rows(dealt) for r in b.to_pylist()]
        return {r["c"]: r["d"] for r in found if r["kind"] == "doc"}, [r for r in found if r["kind"] == "member"]

    assert shared(texts)[1] == []
    sets, members = shared([*texts, [(5, near), (6, near)]])
    assert members and {r["b"] for r in members} == set(sets) and {r["c"] for r in members} == {2}


def test_pairs_of_small_trees_leave_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIRS", 1000)
    monkeypatch.setattr(ngram_join, "PIECE", 1 << 12)
    trees = [[{"rep": 64 * t + i, "component": 64 * t + i // 2} for i in range(64)] for t in range(40)]
    batch = pa.RecordBatch.from_pydict({"tree": list(range(40)), "held": trees})
    found = list(ngram_join.small_trees(iter([batch])))
    assert max(b.num_rows for b in found) <= 1000
    pairs = [(r["u"], r["v"], r["tree"]) for b in found for r in b.to_pylist()]
    assert set(pairs) == {(64 * t + i, 64 * t + k, t) for t in range(40) for k in range(64) for i in range(k) if i // 2 != k // 2}
    assert len(pairs) == len(set(pairs))
    assert max(b.num_rows for b in ngram_join.pieces(iter([batch]), 1 << 12)) < 40


def test_merged_labels_are_the_smallest(session):
    labels = session.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6)], "rep long, component long")
    links = session.createDataFrame([(4, 5), (2, 3), (4, 3)], "u long, v long")
    assert {(r.rep, r.component) for r in ngram_join.merged(labels, links).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 6)}


def test_near_copies_of_a_text_that_a_row_without_an_id_has_too(session):
    words = [f"w{i}" for i in range(80)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(None, text), (1, text), (2, near)]
    docs = session.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOC).coalesce(1)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_components(docs).collect())
    assert found == jaccard_components(rows, 4, 85)


def test_the_pipeline_drops_near_copies_from_four_fifths_on(session):
    random.seed(9)
    rows = []
    for i, changes in enumerate([3, 3, 3, 4, 4, 5, 5, 9]):  # 160 words: 0.82 with three far words changed, below 0.8 from four on
        words = [f"w{random.randint(0, 10**6)}" for _ in range(160)]
        rows.append((10 * i, " ".join(words)))
        for k in range(changes):
            words[10 + 15 * k] = f"n{k}"
        rows.append((10 * i + 1, " ".join(words)))
    docs = session.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOC)
    expected = {c for _, _, c in jaccard_components(rows, 5, 80)}
    assert {d for d, _ in rows} - expected == {1, 11, 21} and jaccard_components(rows, 5, 85) == Counter((d, 156, d) for d, _ in rows)
    assert {r.doc_id for r in corpus_pipeline.dedup_documents(session, docs, SF).collect()} == expected


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_key_of_the_rarest(percent):
    """Of sets around the threshold, the linked ones share one of the keys that are not left out, in any order of the keys."""
    rng = np.random.default_rng(percent)
    shape = ngram_join.Shape(percent)
    draw = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    linked = 0
    for n in [1, 2, 3, 4, 5, 6, 8, 12, 20, 50, 200] * 20:
        a = np.unique(draw(n))
        lost, new = (int(rng.integers(0, n * (100 - percent) // 100 + 2)) for _ in "ab")
        b = np.unique(np.concatenate([rng.permutation(a)[lost:], draw(new)]))
        common = len(np.intersect1d(a, b))
        if not common or 100 * common < percent * (len(a) + len(b) - common):
            continue
        linked += 1
        keys, owner, spare = ngram_join.tree_keys([a, b], shape)
        order = rng.permutation(np.unique(keys))
        place = dict(zip(order.tolist(), range(len(order))))
        left = []
        for i, s in enumerate((a, b)):
            own = int(shape.classes(np.array([len(s)]))[0])
            assert spare[i, 0] & 255 == own
            mine = set()
            for tree, more in ((own, spare[i, 0] >> 8), (own - 1, spare[i, 1])):
                held = sorted((k for k in set(keys[owner == i].tolist()) if k & 255 == tree), key=place.get)
                mine |= set(held[: len(held) - int(more)])
            left.append(mine)
        assert left[0] & left[1], (n, len(a), len(b), common)
    assert linked > 40


def test_the_bound_never_falls_below_the_overlap():
    rng = np.random.default_rng(1)
    shape = ngram_join.Shape(85)
    for n in (7, 30, 400):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n - n // 10], rng.integers(0, 2**63, n // 10, dtype=np.uint64)]))
        tree = int(min(shape.classes(np.array([len(a), len(b)]))))
        points = []
        for x in (a, b):
            cell, _ = ngram_join.counted(x, np.zeros(len(x), dtype=np.int64), shape.groups(np.array([tree])))
            points.append(np.bincount(cell, minlength=int(shape.groups(np.array([tree]))[0])))
        assert np.minimum(*points).sum() >= len(np.intersect1d(a, b))


def test_full_cells_pass_the_bound():
    full = np.full((1, 4), ngram_join.FULL, dtype=np.uint8)
    few = np.array([[3, 0, 1, 0]], dtype=np.uint8)
    assert ngram_join.may_link(full, full, np.array([10**6])).all()
    assert not ngram_join.may_link(full, few, np.array([5])).any() and ngram_join.may_link(full, few, np.array([4])).all()


@pytest.mark.parametrize("n", [15, 60, 200])
def test_clustered_vectors_have_all_their_neighbours(session, n):
    """Every query gets k rows where there are k candidates, also when the parts are smaller than that."""
    rng = np.random.default_rng(n)
    centres = rng.standard_normal((8, 16)) * 10
    rows = [(i, [float(x) for x in centres[i % 8] + rng.standard_normal(16) * 0.01]) for i in range(n)]
    vectors = session.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = Counter(r.query_id for r in ann_partitions.search(vectors, vectors.where("vec_id % 20 = 0"), 20).collect())
    assert found == {i: min(20, n - 1) for i in range(0, n, 20)}


def test_line_windows(session, edge, empty):
    rows = [
        (1, "a\nb\nc\nd", 1), (2, "x\na\nb\nc\nd\ny", 1), (3, "a\nb", 1), (4, "p\nq\nr\np\nq\nr", 1), (5, "\n\n\n\n", 1),
        (6, "a\nb\nc", 1), (None, "a\nb\nc", 1), (7, None, 1), (8, "", 1),
    ]
    found = {(r.doc_id, r.text, r.n_removed) for r in line_windows.drop_repeated_windows(session.createDataFrame(rows, "doc_id long, text string, starts int")).collect()}
    assert found == {
        (1, "a\nb\nc\nd", 0), (2, "x\ny", 4), (3, "a\nb", 0), (4, "p\nq\nr", 3), (5, "\n\n\n\n", 0),
        (6, "", 3), (None, "a\nb\nc", 0), (7, None, 0), (8, "", 0),
    }
    assert line_windows.drop_repeated_windows(empty).count() == 0
    assert line_windows.drop_repeated_windows(edge).count() == len(EDGE)


# --- pipeline -----------------------------------------------------------------------


def test_pipeline_stages_follow_their_operators(session):
    docs = table(session, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(session, docs, SF), "stage")
        assert docs.columns == before.columns and docs.count() <= before.count(), name
    kept = {r.doc_id: r.text for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](session, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(kept)
    tokenizer = Tokenizer.from_file(JSON)
    for doc, text in list(kept.items())[:40]:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        assert sorted((r.piece, r.ids_crc32) for r in packed if r.doc_id == doc) == [(p, zlib.crc32(ids[4 * s : 4 * (s + n)])) for p, s, n, _ in bin_slack.cut(ids, 1024)]


def test_the_first_stage_takes_what_the_toxicity_query_rejects(session):
    larger = "/root/testdata/sf0.01"
    docs = table(session, larger, "documents")
    rejected = {r.doc_id for r in queries.QUERIES["op10_clause_grammar"](session, larger).collect() if r.predicted == 1}
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](session, docs, larger).collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} - rejected and rejected
