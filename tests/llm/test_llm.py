"""Operators on texts: brute force, round trips with the tokenizer libraries, invariants, held-out accuracy."""

import base64
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernix.functions.words import words
from quernix.llm.leaks import TestSet, find_leaks, remove_leaked, search, suffix_array
from quernix.llm.packing import pack, plan_containers
from quernix.llm.pairs import WordAutomaton, defective_pairs, is_empty, open_structure
from quernix.llm.subjects import SubjectModel, document_subjects, repair, subject_name
from quernix.llm.tokenize import DEFAULT_TOKENIZER, ByteBpe, encode, token_counts

TestSet.__test__ = False


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(DEFAULT_TOKENIZER)


@pytest.fixture(scope="module")
def reference_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(DEFAULT_TOKENIZER)
    t.encode_special_tokens = True
    return t


def ids_of(bpe, text):
    return [i for w in bpe.encode_batch([text])[0] for i in w]


@settings(max_examples=60, deadline=None)
@given(text=st.text(st.characters(exclude_categories=("Cs",)), max_size=80))
def test_ids_equal_library(bpe, reference_tokenizer, text):
    assert ids_of(bpe, text) == reference_tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts(bpe, reference_tokenizer):
    for text in ["", " ", "a" * 3000, "ab" * 1000, "<|endoftext|>", " " * 500 + "x", "é" * 200, "don't\r\n\tI'LL 12345", "😀‍\U000e0001", "\0\x01"]:
        assert ids_of(bpe, text) == reference_tokenizer.encode(text, add_special_tokens=False).ids


def test_long_words_equal_steps(bpe, monkeypatch):
    import quernix.llm.tokenize as module

    text = "".join(random.Random(1).choice("abcdefghij") for _ in range(300))
    long_way = ids_of(bpe, text)
    monkeypatch.setattr(module, "LONG_WORD", 10**6)
    assert ids_of(ByteBpe(DEFAULT_TOKENIZER), text) == long_way


def test_round_trip_and_second_library(bpe):
    import tiktoken

    from quernix.llm.tokenize import PATTERN

    with open(DEFAULT_TOKENIZER.replace(".json", ".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "The verifier reads /app/x_1.csv — für «niños»; it's 42.\n\n"
    assert ids_of(bpe, text) == other.encode_ordinary(text) and other.decode(ids_of(bpe, text)) == text


def test_encoding_of_a_table(spark):
    rows = [(1, "hello world", "x"), (2, "", None), (3, None, None), (None, "a", "y"), (1, "hello world", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted(((r.doc_id or 0), list(r.ids)) for r in encode(df, "doc_id", F.col("text")).collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3] and got[3][1] == [] and got[4][1] == [] and len(got[1][1]) == 2
    assert sorted(r.n_tokens for r in token_counts(df, "doc_id", F.col("text")).collect()) == [0, 0, 1, 2, 2]
    assert encode(df.where("false"), "doc_id", F.col("text")).count() == 0


@settings(max_examples=80, deadline=None)
@given(counts=st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_holds_every_item_once(counts):
    plan = plan_containers(counts, 60)
    held = Counter()
    for p in plan:
        assert sum(p.lengths) <= 60 and p.containers > 0
        for x in p.lengths:
            held[x] += p.containers
    assert held == Counter(counts)


def test_plan_fills_well():
    rng = random.Random(4)
    counts = Counter(min(2048, max(1, int(rng.lognormvariate(5.6, 0.8)))) for _ in range(20_000))
    used = sum(p.containers for p in plan_containers(counts, 2048))
    least = -(-sum(x * n for x, n in counts.items()) // 2048)
    assert used <= 1.002 * least + 2


def test_packed_table(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice([0, None, 5, 100, 100, 250, 37, 1001, -3]) if k % 3 else rng.randrange(1, 100), "c") for k in range(900)] + [(5000, 1000, "c"), (5001, 100, None)]
    df = spark.createDataFrame(rows, "id bigint, n bigint, container_id string")
    out = pack(df, "id", "n", 100, together=7).collect()
    by_item, by_container = defaultdict(list), defaultdict(int)
    for r in out:
        by_item[r.id].append((r.piece, r.size, r.container_id))
        if r.container_id is not None:
            by_container[r.container_id] += r.size
    assert set(by_item) == {r[0] for r in rows} and max(by_container.values()) <= 100
    assert sorted(by_container) == list(range(len(by_container)))
    for i, n, _ in rows:
        parts = sorted(by_item[i])
        assert sum(s for _, s, _ in parts) == max(0, n or 0)
        if (n or 0) <= 0:
            assert parts == [(0, 0, None)]
        else:
            assert len(parts) == -(-n // 100) and all(s == 100 for _, s, _ in parts[:-1])
    again = pack(df.repartition(3), "id", "n", 100, together=7).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, again), key=str)
    assert pack(df.where("false"), "id", "n", 100).count() == 0


def test_suffix_array_and_search():
    import numpy as np

    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 300)
    order = suffix_array(text, 400)
    suffixes = [tuple(text[k:]) for k in order]
    assert suffixes == sorted(suffixes)
    queries = rng.integers(0, 4, 200)
    starts = np.arange(0, 190)
    lengths = rng.integers(1, 10, 190)
    lo, hi = search(text, order, queries, starts, lengths)
    for s, n, a, b in zip(starts, lengths, lo, hi, strict=True):
        q = tuple(queries[s : s + n])
        assert sorted(order[a:b].tolist()) == [k for k in range(300) if tuple(text[k : k + n]) == q]


def brute_leaks(texts, items, least):
    cut = lambda t: [words(s) for s in re.split(r"\.(?=\s|\Z)", t)]
    whole = {t: " " + " ".join(w for s in cut(i) for w in s) + " " for t, i in items}
    out = set()
    for corpus, key, text in texts:
        w = words(text or "")
        joined = " " + " ".join(w) + " "
        for task, instruction in items:
            for s in cut(instruction):
                for a in range(len(s)):
                    for b in range(a + least, len(s) + 1):
                        run = " " + " ".join(s[a:b]) + " "
                        if run in joined and not any(run in x for o, x in whole.items() if o != task):
                            out.add((corpus, key, task))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_leaks_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["alpha", "beta", "Gamma", "delta", "x1", "naïve"]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = sentence(8)
    items = [(f"t{k}", f"{sentence(9)}. {shared if k < 3 else sentence(7)}. {sentence(3)} v{k}.txt {sentence(4)}.") for k in range(8)]
    texts = []
    for k in range(60):
        body = sentence(rng.randrange(0, 12))
        if k % 2:
            ws = rng.choice(items)[1].split(" ")
            a = rng.randrange(len(ws))
            body += " " + rng.choice([" ".join(ws[a : a + 9]).upper(), "​" + ", ".join(ws[a : a + 9])]) + " " + sentence(2)
        texts.append(("c", f"r{k}", body))
    texts += [("c", "null", None), ("c", "empty", ""), ("c", None, items[0][1]), ("c", "r1", items[0][1]), ("d", "r1", shared)]
    df = spark.createDataFrame(texts, "corpus string, record_id string, text string").withColumn("task_id", F.lit("x"))
    known = spark.createDataFrame([*items, ("nul", None), (None, "x y")], "task_id string, instruction string")
    found = find_leaks(df, known, least=5)
    want = brute_leaks([t for t in texts if t[1]], items, 5)
    assert {(r.corpus, r.record_id, r.task_id) for r in found.collect()} == want and want
    clean = remove_leaked(df.where("corpus = 'c'"), found.where("corpus = 'c'"))
    assert not {r.record_id for r in clean.collect()} & {k for c, k, _ in want if c == "c"}


def test_leaks_of_nothing(spark):
    empty = spark.createDataFrame([], "corpus string, record_id string, text string")
    assert find_leaks(empty, spark.createDataFrame([("t", "a b c d e f g h i j k.")], "task_id string, instruction string")).count() == 0
    assert find_leaks(empty, spark.createDataFrame([], "task_id string, instruction string")).count() == 0


def test_word_automaton():
    rng = random.Random(2)
    for _ in range(40):
        a, b = ([rng.choice("xyz") for _ in range(rng.randrange(1, 14))] for _ in range(2))
        got = WordAutomaton(a).covered(b, 2)
        grams = {tuple(a[i:j]) for i in range(len(a)) for j in range(i + 2, len(a) + 1)}
        want = [False] * len(b)
        for i in range(len(b)):
            for j in range(i + 2, len(b) + 1):
                if tuple(b[i:j]) in grams:
                    want[i:j] = [True] * (j - i)
        assert got == want


QUESTION = "How do I archive the weight decay in x.toml without losing the model card?"
ANSWER = "Make a copy of y.csv first, because perl writes in place and the model card would be gone."
CASES = [
    (QUESTION, ANSWER, None),
    (QUESTION, None, "empty"), (QUESTION, "", "empty"), (QUESTION, " ​\n", "empty"), (QUESTION, "```\n```", "empty"), (QUESTION, "N/A", "empty"), (QUESTION, "<answer></answer>", "empty"), (QUESTION, '{"answer": ""}', "empty"),
    (QUESTION, "42", None), (QUESTION, "Yes.", None), (QUESTION, "Use `jq -n 3`.", None),
    (QUESTION, QUESTION.upper(), "copy"), (QUESTION, "> " + QUESTION, "copy"), (QUESTION, QUESTION[:-1], "copy"), (QUESTION, "You asked: " + QUESTION.replace("weight", "old"), "copy"),
    (QUESTION, f"> {QUESTION}\n\n{ANSWER}", None), (QUESTION, f"{QUESTION}\n\nYes.", None),
    (QUESTION, "I'm sorry, but I can't help with this request. Please consult a qualified person.", "refusal"), (QUESTION, "**I must turn this down.**", "refusal"), (QUESTION, "Leider kann ich dabei nicht helfen.", "refusal"),
    (QUESTION, "Sorry for the confusion earlier. " + ANSWER, None), (QUESTION, "I'm afraid I can't help with sed here. " + ANSWER, None),
    (QUESTION, "Lege zuerst eine Kopie von y.csv an, denn perl schreibt direkt in die Datei.", "other_language"), ("Reply in German. " + QUESTION, "Lege zuerst eine Kopie von y.csv an, denn perl schreibt direkt in die Datei.", None),
    (QUESTION, ANSWER + "\n```bash\nsed -n 3", "truncated"), (QUESTION, '{\n  "answer": "Make a copy', "truncated"), (QUESTION, ANSWER + " Run it once with sed and compare the", "truncated"), (QUESTION, "Make a copy of y.csv first,", "truncated"),
    (QUESTION, '{"answer": "Make a copy of it first."}', None), (QUESTION, ANSWER + "\n```bash\nsed -n 3 x\n```", None), (QUESTION, "- Run it once\n- Sort by date", None),
    (None, ANSWER, None),
]


def test_pair_cases(spark):
    rows = [(f"t{k}", [("system", "x"), ("user", q), ("assistant", a), ("user", "last")], "e") for k, (q, a, _) in enumerate(CASES)]
    # enough other text to know how sentences end
    rows += [(f"z{k}", [("user", QUESTION), ("assistant", f"Run it once with sed and compare the {k} lines it prints. " + ANSWER)], "e") for k in range(6)]
    rows += [rows[1], ("none", None, None), ("bare", [], None), (None, [("user", "a"), ("assistant", "")], None), ("roles", [(None, "a"), ("assistant", ""), ("assistant", "")], None)]
    df = spark.createDataFrame(rows, "trial_name string, conversations array<struct<role: string, content: string>>, defect string")
    got = {(r.trial_name, r.turn): r.defect for r in defective_pairs(df, "trial_name", "conversations").collect()}
    want = {(f"t{k}", 2): d for k, (_, _, d) in enumerate(CASES) if d}
    assert got == want
    assert defective_pairs(df.where("false"), "trial_name", "conversations").count() == 0


def test_structures_and_stand_ins():
    assert open_structure("a ```x") and open_structure('[1, {"a": "b') and not open_structure('{"a": 1}') and open_structure("so « cela")
    assert is_empty("null") and is_empty("{}") and is_empty('""') and not is_empty("0") and not is_empty("None of them are.")


def test_subject_helpers():
    assert subject_name(" Machine  Learning ") == "machine_learning" and subject_name(None) is None
    assert repair("fÃ¼r GelÃ©e") == "für Gelée" and repair("naïve Ä") == "naïve Ä"


def _held_out(spark, folder):
    docs, areas, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "subject_areas", "doc_labels"))
    known = labels.where("doc_id % 2 = 0")
    got = document_subjects(docs, areas, known).collect()
    return docs, areas, labels.where("doc_id % 2 = 1").collect(), got


def test_subjects_held_out(spark):
    docs, areas, held, got = _held_out(spark, "/root/testdata/sf0.1")
    names = {r.subject for r in areas.collect()}
    found = defaultdict(set)
    for r in got:
        found[r.doc_id].add(r.subject)
    assert {s for v in found.values() for s in v} <= names
    true = defaultdict(set)
    for r in held:
        if (s := subject_name(r.subject)) in names:
            true[r.doc_id].add(s)
    hit = sum(len(true[d] & found[d]) for d in true)
    # about a seventh of the labels are wrong
    assert hit / sum(len(v) for v in true.values()) > 0.8 and hit / sum(len(found[d]) for d in true) > 0.8
    blank = {r.doc_id for r in docs.collect() if not (r.text or "").strip()}
    assert not blank & set(found) and len(found) >= docs.count() - len(blank) - 20


def test_subjects_defined_cases(spark):
    areas = spark.createDataFrame([("law", "courts"), ("food", None), (None, "x")], "subject string, description string")
    rows = [(k, "court judge statute court", "a") for k in range(30)] + [(100 + k, "soup broth soup pantry", "a") for k in range(30)] + [(200, None, "a"), (201, " ​ ", "a"), (202, "12345 !!", "a"), (0, "court judge statute court", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, subject string")
    labels = spark.createDataFrame([(k, "LAW ", "x") for k in range(5)] + [(100 + k, "Food", "x") for k in range(5)] + [(7, None, "x"), (8, "nonsense", "x"), (9999, "law", "x")], "doc_id bigint, subject string, annotator string")
    m = SubjectModel(common=0.9)
    got = defaultdict(set)
    for r in document_subjects(docs, areas, labels, m).collect():
        got[r.doc_id].add(r.subject)
    assert all(got[k] == {"law"} for k in range(30)) and all(got[100 + k] == {"food"} for k in range(30))
    assert 200 not in got and 201 not in got and len(got[202]) == 1
    assert document_subjects(docs.where("false"), areas, labels, m).count() == 0
    assert document_subjects(docs, areas.where("false"), labels, m).count() == 0
    assert document_subjects(docs, areas, labels.where("false"), m).count() > 0


def _law_and_food(spark):
    rng = random.Random(5)
    law, food, rest = ("court judge statute appeal verdict counsel", "soup broth pantry oven butter flour", "with that from into over then")
    text = lambda ws: " ".join(rng.choices(ws.split(), k=14) + rng.choices(rest.split(), k=8))
    rows = [(k, text(law)) for k in range(40)] + [(100 + k, text(food)) for k in range(40)]
    labels = [(k, "law") for k in range(20)] + [(100 + k, "food") for k in range(20)]
    areas = spark.createDataFrame([("law", "-"), ("food", "-")], "subject string, description string")
    return rows, areas, spark.createDataFrame(labels, "doc_id bigint, subject string")


def test_subjects_by_words_of_most_documents(spark):
    """Every telling word is in a third of all documents or more, and a third of them are copies of one text."""
    rows, areas, labels = _law_and_food(spark)
    docs = spark.createDataFrame(rows + [(1000 + k, rows[0][1]) for k in range(40)], "doc_id bigint, text string")
    got = {(r.doc_id, r.subject) for r in document_subjects(docs, areas, labels).collect()}
    assert got == {(d, "food" if 100 <= d < 1000 else "law") for d in [*(k for k, _ in rows), *range(1000, 1040)]}


def test_answer_that_repeats_a_later_line_speaks_otherwise(spark):
    later = "I have tried to do it with sed, but the output is not what I want and it is in the wrong place."
    answer = f"> {later}\n\nLege zuerst eine Kopie von y.csv an, denn perl schreibt direkt in die Datei."
    rows = [("a", [("user", f"{QUESTION}\n{later}"), ("assistant", answer)]), ("b", [("user", f"{QUESTION}\n{later}"), ("assistant", f"> {later}\n\n{ANSWER}")])]
    df = spark.createDataFrame(rows, "id string, m array<struct<role: string, content: string>>")
    assert {(r.id, r.defect) for r in defective_pairs(df, "id", "m").collect()} == {("a", "other_language")}


def test_leaf_of_equal_vectors_is_split(spark):
    import numpy as np

    from quernix.llm.subjects import bisecting_kmeans

    vec = lambda k: bytearray(np.eye(4, dtype=np.float16)[k].tobytes())
    rows = [(bytearray(f"{k}".encode()), vec(int(k % 500 == 0)), 1) for k in range(2000)]
    _, sizes = bisecting_kmeans(spark.createDataFrame(rows, "digest binary, vec binary, n bigint"), 4, SubjectModel())
    assert sorted(sizes.values()) == [4, 1996]


def test_subjects_come_from_leaf_mixtures():
    import numpy as np

    from quernix.llm.subjects import mixtures

    # own mentions are 0.87 and 0.13; the leaf near it says what part the second subject has
    x = np.array([[0.989, 0.148]], dtype=np.float32)
    of = lambda *leaves: mixtures(x, np.array(leaves, dtype=np.float32), 50.0)[0].tolist()
    assert of([1.0, 0.0], [0.0, 1.0]) == pytest.approx([1.0, 0.0], abs=1e-6)
    assert of([0.8, 0.6], [0.0, 1.0]) == pytest.approx([0.571, 0.429], abs=1e-3)
    assert 0.6 < of([1.0, 0.0], [0.95, 0.31])[0] < 1.0


def test_subjects_of_mixed_documents(spark):
    rows, areas, labels = _law_and_food(spark)
    mixed = [(500 + k, f"{rows[k][1]} {rows[40 + k][1]}") for k in range(10)]
    docs = spark.createDataFrame(rows + mixed, "doc_id bigint, text string")
    found = defaultdict(set)
    for r in document_subjects(docs, areas, labels).collect():
        found[r.doc_id].add(r.subject)
    assert all(found[d] == {"law", "food"} for d, _ in mixed) and all(len(found[d]) == 1 for d, _ in rows)


def test_leak_in_one_corpus_leaves_the_same_id_of_another(spark):
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    corpus = spark.createDataFrame([("documents", "7", item), ("sft_messages", "7", "nothing of it"), ("sft_messages", "8", item)], "corpus string, record_id string, text string")
    found = find_leaks(corpus, spark.createDataFrame([("t1", item)], "task_id string, instruction string"))
    assert {tuple(r) for r in remove_leaked(corpus.select("corpus", "record_id"), found).collect()} == {("sft_messages", "7")}


def test_plan_of_large_containers():
    """Capacity 32,768 with items of every length: little memory, no container over capacity, hardly any room left."""
    import tracemalloc

    rng = random.Random(11)
    counts = Counter(min(32_768, int(rng.lognormvariate(6.5, 1.4)) + 1) for _ in range(40_000))
    tracemalloc.start()
    plan = plan_containers(counts, 32_768)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    held: Counter = Counter()
    for p in plan:
        assert sum(p.lengths) <= 32_768
        for x in p.lengths:
            held[x] += p.containers
    assert held == counts and peak < 200e6
    assert sum(p.containers for p in plan) <= sum(x * n for x, n in counts.items()) / 32_768 * 1.01 + 2


def test_many_items_of_one_length(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id < 2000 THEN 300 ELSE 30 END AS n")
    out = pack(df, "id", "n", 100, together=50).collect()
    fill: Counter = Counter()
    for r in out:
        fill[r.container_id] += r.size
    assert max(fill.values()) <= 100 and len(out) == 2000 * 3 + 1000 and len({(r.id, r.piece) for r in out}) == len(out)
    assert sorted(fill) == list(range(6000 + 334))


def test_long_words_by_the_merge_query(bpe, reference_tokenizer):
    rng = random.Random(4)
    texts = ["a" * 3000, "ab" * 700, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1500)), "=" * 777, " " * 999 + "x", "ééé" * 200, "0123456789" * 90]
    for text, ws in zip(texts, bpe.encode_batch(texts), strict=True):
        assert [i for w in ws for i in w] == reference_tokenizer.encode(text, add_special_tokens=False).ids


def test_markup_of_any_length_is_empty():
    assert is_empty('<div class="' + "x " * 200 + '"></div>') and not is_empty("<b>" + "x" * 90 + "</b>")


REFUSALS_NOT_IN_ANY_LIST = [
    "I'm sorry, but I cannot provide an answer to that.", "I will not assist with this one. Best of luck elsewhere.", "I'm afraid I'm not able to respond here.", "Sorry. I don't discuss such topics.",
    "Das kann ich leider nicht beantworten. Alles Gute.", "Je refuse de traiter cette demande. Bonne journée.", "No voy a responder. Un saludo.",
]
ANSWERS_WITH_APOLOGY = ["Sorry, I cannot help with sed there, but awk does it. Split the lines at the comma and sum the second column.", "I can't provide the output itself. The invoice totals are in column 3."]


def test_refusals_by_rule():
    from quernix.functions.words import fold
    from quernix.llm.pairs import REFUSALS, _automaton, is_refusal

    refusals, asked = _automaton(REFUSALS), words("How do I sum the second column of the invoice with sed?")
    assert all(is_refusal(fold(x), asked, refusals) for x in REFUSALS_NOT_IN_ANY_LIST)
    assert not any(is_refusal(fold(x), asked, refusals) for x in ANSWERS_WITH_APOLOGY)
