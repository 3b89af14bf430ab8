"""Selection, de-duplication, sequences, responses, sources and sinks against plain mirrors."""

import hashlib
import io
import json
import os
import random
import tarfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quernix import schemas
from quernix.functions import numeric as N
from quernix.functions.pyfunctions import balanced_objects, normalize_response, token_mask, trained_spans
from quernix.operators import selection as S
from quernix.operators.dedup import greedy_two_key
from quernix.operators.gates import first_failure
from quernix.operators.sequences import assemble_turns, next_fit
from quernix.plans.task_pool import leaked_verifiers, missing_files
from quernix.sources import readers, writers

RESPONSE = {"analysis": "a", "plan": "p", "commands": [{"keystrokes": "ls\n"}]}


@pytest.mark.parametrize("seed", range(4))
def test_greedy_dedup_equals_scan(spark, seed):
    rng = random.Random(seed)
    rows = [(f"t{k:03d}", f"c{rng.randrange(25)}", f"g{rng.randrange(5)}", f"s{rng.randrange(7)}") for k in range(120)]
    contents, behaviours, want = set(), set(), []
    for i, c, g, s in sorted(rows):
        if c not in contents and (g, s) not in behaviours:
            contents.add(c)
            behaviours.add((g, s))
            want.append(i)
    df = spark.createDataFrame(rows, "id string, c string, g string, s string")
    assert sorted(r.id for r in greedy_two_key(df, "id", "c", ["g", "s"]).collect()) == want


def test_rotation_equals_loop(spark):
    rng = random.Random(5)
    rows = [(f"t{k:03d}", f"g{rng.choice('aaab')}", rng.choice("xyz")) for k in range(150)]
    key = lambda i: hashlib.sha256(f"9:{i}".encode()).hexdigest()
    want = []
    for g in {r[1] for r in rows}:
        piles = defaultdict(list)
        for i, _, m in sorted((r for r in rows if r[1] == g), key=lambda r: key(r[0])):
            piles[m].append(i)
        turn = [(k, m, i) for m, ids in piles.items() for k, i in enumerate(ids)]
        want += [i for _, _, i in sorted(turn)[:10]]
    got = S.rotate_sources(spark.createDataFrame(rows, "id string, g string, m string"), "g", "m", "id", 10, 9)
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_holdout_is_disjoint_and_reaches_target(spark):
    rows = [(f"r{k}", f"g{k % 37}") for k in range(1000)]
    out = S.holdout_until(spark.createDataFrame(rows, "id string, g string"), "g", 100, 0.15)
    held = out.where("split = 'holdout'").count()
    assert 100 <= held < 100 + 28
    assert S.shared_groups(out, "g").count() == 0


def test_numbered_is_a_total_order(spark):
    df = spark.range(0, 999, 1, 7).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    got = S.numbered(df, ["k"]).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(999)) and [r.k for r in got] == sorted(r.k for r in got)


def test_next_fit(spark):
    sizes = [5, 5, 1, 20, 3, 3, 9]
    got = spark.createDataFrame([(sizes,)], "s array<bigint>").select(next_fit(F.col("s"), 10).alias("b")).first().b
    assert got == [0, 0, 1, 2, 3, 3, 4]


def test_assembled_turns():
    assert assemble_turns([[1, 2], [1, 2, 3, 4]], [[3], [5]]) == ([1, 2, 3, 4, 5], [0, 0, 1, 0, 1])
    assert assemble_turns([[1], [9, 9]], [[2], [3]]) is None


@pytest.mark.parametrize(
    "raw,reason,rewritten",
    [
        (json.dumps(RESPONSE, indent=2), "ok", False),
        (json.dumps(RESPONSE), "ok", True),
        ("Run find . -exec ls {} ; first\n" + json.dumps(RESPONSE), "ok", True),
        ("```json\n" + json.dumps(RESPONSE) + "\n```", "ok", True),
        (json.dumps(RESPONSE).replace('"a"', '"a\nb"'), "ok", True),
        (json.dumps(RESPONSE) + " and then", "ok", True),
        ('{"analysis": "x"}', "missing_required_keys", False),
        (json.dumps({**RESPONSE, "commands": "ls"}), "commands_not_list", False),
        ('{"analysis": "x", "plan', "unparseable", False),
        ("", "unparseable", False),
        (None, "unparseable", False),
    ],
)
def test_responses(raw, reason, rewritten):
    canonical, again, got = normalize_response(raw)
    assert (got, again) == (reason, rewritten)
    if reason == "ok":
        assert normalize_response(canonical) == (canonical, False, "ok")


def test_balanced_objects():
    assert balanced_objects('a {"x": "}"} b {} {"y": {"z": 1}} {"open') == ['{"x": "}"}', "{}", '{"y": {"z": 1}}']


def test_masks_by_two_ways():
    text = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<think>\nok<|im_end|>\n"
    spans = trained_spans(text, [True])
    for step in (1, 3, 7):
        offsets = [(k, min(k + step, len(text))) for k in range(0, len(text), step)]
        on = {p for s, e in spans for p in range(s, e)}
        assert token_mask(len(text), spans, offsets) == [int(any(p in on for p in range(a, b))) for a, b in offsets]
    with pytest.raises(ValueError):
        trained_spans(text, [True, True])


def test_order_statistics(spark):
    import statistics

    from quernix.operators.selection import order_statistics

    rng = random.Random(2)
    sets = {n: sorted(rng.choice([rng.random(), 0.5]) for _ in range(n)) for n in (1, 5, 10, 11, 57, 101, 250)}
    df = spark.createDataFrame([(n, v) for n, vs in sets.items() for v in vs] + [(1, None), (999, None)], "k int, v double").repartition(5)
    places = {f"{name}{k}": lambda n, c=c, k=k: N.exclusive_places(n, *c) + k for name, c in (("a", (10, 9)), ("b", (100, 99))) for k in (0, 1)}
    places["r"] = lambda n: N.nearest_rank_place(n, 0.9)
    got = order_statistics(df, ["k"], "v", places)
    rows = got.select("k", "r", N.exclusive_quantile(F.col("n"), F.col("a0"), F.col("a1"), 10, 9).alias("a"), N.exclusive_quantile(F.col("n"), F.col("b0"), F.col("b1"), 100, 99).alias("b")).collect()
    assert {r.k for r in rows} == set(sets)
    for r in rows:
        v, n = sets[r.k], r.k
        assert r.a == pytest.approx(statistics.quantiles(v, n=10)[8] if n > 10 else v[-1])
        assert r.b == pytest.approx(statistics.quantiles(v, n=100)[98] if n > 100 else v[-1])
        assert r.r == v[min(n - 1, int(0.9 * n))]


def test_trained_chars_equal_spans(spark):
    from quernix.functions.pyfunctions import trained_chars
    from quernix.functions.text import chat_render

    talks = [[("user", "a"), ("assistant", "b c")], [("user", "a"), ("assistant", "<think>\nx</think>y"), ("user", "é"), ("assistant", None)], [("system", "s"), ("user", "u"), ("assistant", ""), ("user", "v")]]
    df = spark.createDataFrame([(t,) for t in talks], "m array<struct<role: string, content: string>>")
    for r in df.select("m", chat_render(F.col("m")).alias("text"), trained_chars(F.col("m")).alias("n")).collect():
        spans = trained_spans(r.text, [True] * sum(x.role == "assistant" for x in r.m))
        assert r.n == sum(e - s for s, e in spans)


def test_conversations_in_one_pass(spark):
    from quernix.plans.sft_build import conversations

    good = '{"analysis": "a", "plan": "b", "commands": [{"keystrokes": "ls\\n"}]}'
    preamble = "Previous response had warnings:\n- x\n\nNew Terminal Output:\ny"
    rows = [
        ("ok", [("user", "q"), ("assistant", f"text {good}"), ("user", preamble), ("assistant", json.dumps(json.loads(good), indent=2)), ("user", preamble), ("assistant", good)]),
        ("bad", [("user", "q"), ("assistant", "none"), ("user", " "), ("assistant", None)]),
        ("null", None), ("empty", []), ("role", [(None, "x"), ("assistant", good)]), ("end", [("user", "x")]),
    ]
    df = spark.createDataFrame(rows, "id string, messages array<struct<role: string, content: string>>").withColumn("drop_reason", F.lit("old"))
    got = {r.id: r for r in conversations(df).collect()}
    ok = got["ok"]
    assert ok.drop_reason is None and (ok.n_assistant_turns, ok.n_rewritten_turns) == (3, 2)
    assert [m.content for m in ok.messages][2] == "New Terminal Output:\ny" and ok.messages[4].content == preamble
    assert ok.messages[1].content == ok.messages[3].content == json.dumps(json.loads(good), indent=2)
    assert ok.command_signature == hashlib.sha256(b"ls\n\0ls\n\0ls\n").hexdigest()
    plain = [{"role": m.role, "content": m.content} for m in ok.messages]
    assert ok.content_hash == hashlib.sha256(json.dumps(plain, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    reasons = {k: r.drop_reason for k, r in got.items() if k != "ok"}
    assert reasons == {"bad": "unparseable", "null": "empty_conversation", "empty": "empty_conversation", "role": "unexpected_role", "end": "not_assistant_terminated"}
    assert got["null"].messages is None and got["empty"].messages == [] and got["null"].content_hash is None
    assert conversations(df.where("false")).count() == 0


def test_first_failure_order(spark):
    df = spark.createDataFrame([(1, None), (5, None), (9, True)], "n int, b boolean")
    got = df.select(first_failure([("low", F.col("n") < 3), ("flag", F.col("b")), ("any", F.col("n") > 4)]).alias("r")).collect()
    assert [r.r for r in got] == ["low", "any", "flag"]


def test_required_columns(spark):
    df = spark.createDataFrame([("a", 1)], "task_id string, run int")
    with pytest.raises(ValueError, match="reward: double expected, missing"):
        schemas.require_columns(df, schemas.ATTEMPTS)
    assert schemas.require_single_value(df, "task_id") == "a"


def test_leaked_and_missing_files(spark):
    rows = [("a", "tests/test.sh", "1"), ("a", "environment/x", "1"), ("b", "environment/tests/test.sh", "9"), ("c", "tests/test.sh", "2"), ("c", "environment/x", "1")]
    files = spark.createDataFrame(rows, "task_id string, rel string, sha256 string")
    assert {r.task_id: r.rel for r in leaked_verifiers(files).collect()} == {"a": "environment/x", "b": "environment/tests/test.sh"}
    assert all(len(r.missing) == 5 if r.task_id in "ac" else len(r.missing) == 6 for r in missing_files(files).collect())


def _tar(path, members):
    with tarfile.open(path, "w") as tar:
        for name, body in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))


def test_archives(spark, tmp_path):
    doc = json.dumps({"steps": [{"source": "user", "message": "hi"}]}).encode()
    _tar(tmp_path / "s0.tar", {"t/a/trajectory.json": doc, "t/a/x/y.txt": b"1", "t/ab/trajectory.json": b"{broken"})
    members = readers.tar_members(spark, str(tmp_path))
    wanted = spark.createDataFrame([("s0.tar", "t/a/", "A"), ("s0.tar", "t/ab", "B")], "shard string, member_prefix string, id string")
    got = readers.trajectory_steps(readers.wanted_members(members, wanted), schemas.TRAJECTORY_RECORD).collect()
    assert {r.id: r.record.steps[0].message if r.record and r.record.steps else None for r in got} == {"A": "hi", "B": None}
    assert {(r.id, r.rel) for r in readers.under_prefix(members, wanted).collect()} == {("A", "trajectory.json"), ("A", "x/y.txt"), ("B", "trajectory.json")}
    bad = spark.createDataFrame([("s0.tar", "t/a/../../etc", b"")], "shard string, member string, content binary")
    with pytest.raises(Exception, match="unsafe member path"):
        readers.under_prefix(bad, wanted).collect()


def test_files(spark, tmp_path):
    head = json.dumps({"w": {"dtype": "F32", "shape": [2, 3], "data_offsets": [0, 24]}, "__metadata__": {}}).encode()
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.safetensors").write_bytes(len(head).to_bytes(8, "little") + head + b"\0" * 24)
    row = readers.safetensors_catalogue(spark, str(tmp_path / "m")).first()
    assert (row.key, row.shape, row.nbytes) == ("w", [2, 3], 24)
    files = readers.file_fingerprints(spark, str(tmp_path / "m"))
    assert readers.fingerprint(files, "c") == readers.fingerprint(files, "c") != readers.fingerprint(files, "d")
    manifest = spark.createDataFrame([("a.safetensors", 1, "x"), ("b", 1, "x")], "shard string, size_bytes bigint, sha256 string")
    assert {r.shard: r.problem for r in readers.verify_manifest(files, manifest).collect()} == {"a.safetensors": "size", "b": "missing"}
    job = tmp_path / "job"
    for p in ("result.json", "t1/result.json", "trials/t2/result.json", "a/b/result.json"):
        (job / p).parent.mkdir(parents=True, exist_ok=True)
        (job / p).write_text("{}")
    assert readers.result_documents(spark, str(job)).count() == 3
    for p in ("one", "two"):
        (tmp_path / "tasks_root" / "tasks" / p).mkdir(parents=True)
        (tmp_path / "tasks_root" / "tasks" / p / "instruction.md").write_text("x")
    assert readers.task_folders(spark, str(tmp_path / "tasks_root")).count() == 2
    logs = tmp_path / "logs"
    logs.mkdir()
    for k in range(6):
        (logs / f"r{k}.log").write_bytes(b"step: 1 loss: 0.5\n\xff bad\n")
        os.utime(logs / f"r{k}.log", (1000 + k, 1000 + k))
    newest = readers.newest_logs(spark, str(logs))
    assert [p.rsplit("/", 1)[1] for p in newest] == ["r2.log", "r3.log", "r4.log", "r5.log"]
    assert readers.log_curve_source(spark, newest).where("loss = 0.5 and step = 1").count() == 4
    assert readers.existing(spark, [str(logs), str(tmp_path / "none")]) == [str(logs)]


def test_documents_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1), (None, 2)], "x string, n int")
    assert "a\\|b" in writers.render_report("R", {"S": df})
    writers.write_text(spark, str(tmp_path / "d.json"), '{"a": 1}')
    (tmp_path / "bad.json").write_text("{oops")
    got = readers.json_documents(spark, str(tmp_path)).select("path", F.try_variant_get("document", "$.a", "int").alias("a")).collect()
    assert {r.path.rsplit("/", 1)[1]: r.a for r in got} == {"d.json": 1, "bad.json": None}
    writers.publish(spark, {"t": df, "u": df}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "t")).count() == 2
    assert writers.stage_done(spark, str(tmp_path / "out" / "u")) and not writers.stage_done(spark, str(tmp_path / "none"))
    assert not writers.exclusions(df.where("false"), str(tmp_path / "ex")) and writers.exclusions(df, str(tmp_path / "ex"))
    writers.append_json_lines(df, str(tmp_path / "j"))
    writers.append_json_lines(df, str(tmp_path / "j"))
    assert readers.json_lines(spark, str(tmp_path / "j"), "x string, n int").count() == 4


def test_form_pairs_equals_loop(spark):
    rng = random.Random(8)
    rows = [(f"t{k:03d}", f"k{rng.randrange(6)}", rng.choice("xyz"), rng.random() < 0.4) for k in range(140)]
    for cap in (1, 3, 30):
        want = set()
        for key in {r[1] for r in rows}:
            won = sorted(r for r in rows if r[1] == key and r[3])
            lost = sorted(r for r in rows if r[1] == key and not r[3])
            pairs = []
            for m in sorted({r[2] for r in rows}):
                pairs += list(zip([r for r in won if r[2] == m], [r for r in lost if r[2] == m], strict=False))
            pairs = pairs[:cap]
            used = {x for p in pairs for x in p}
            pairs += list(zip([r for r in won if r not in used], [r for r in lost if r not in used], strict=False))[: cap - len(pairs)]
            want |= {(w[0], lo[0]) for w, lo in pairs}
        got = S.form_pairs(spark.createDataFrame(rows, "id string, k string, m string, win boolean"), "k", "m", "id", "win", cap)
        assert {(r.chosen, r.rejected) for r in got.collect()} == want


def test_conversation_tokens_and_mask(spark):
    from quernix.functions.text import chat_render
    from quernix.functions.tokens import DEFAULT_TOKENIZER, tokenizer, with_conversation_tokens, with_token_ids

    talks = [[("user", "a b"), ("assistant", "<think>\nx</think>é 😀 y"), ("user", "c"), ("assistant", "d")], [("system", "s"), ("user", "<|endoftext|>")], [], None]
    df = spark.createDataFrame([(k, t, "old") for k, t in enumerate(talks)], "k int, messages array<struct<role: string, content: string>>, input_ids string")
    t = tokenizer(DEFAULT_TOKENIZER)
    for r in with_conversation_tokens(df).withColumn("text", chat_render(F.col("messages"))).collect():
        if not r.messages:
            assert r.input_ids == [] and r.loss_mask == []
            continue
        e = t.encode(r.text, add_special_tokens=False)
        on = {p for a, b in trained_spans(r.text, [True] * sum(m.role == "assistant" for m in r.messages)) for p in range(a, b)}
        assert r.input_ids == e.ids and r.loss_mask == [int(any(p in on for p in range(a, b))) for a, b in e.offsets]
        assert r.loss_mask[0] == 0 and (sum(r.loss_mask) > 0) == (r.k == 0)
    texts = spark.createDataFrame([("a  b\n\n c",), ("",), (None,)], "text string")
    assert [r.input_ids for r in with_token_ids(texts, F.col("text")).collect()] == [t.encode("a  b\n\n c", add_special_tokens=False).ids, [], []]


def test_greedy_dedup_of_a_long_chain(spark):
    """Each row shares its content with the one before it or its behaviour with the one after it, in turn."""
    rows = [(k, f"c{(k + 1) // 2}", f"b{k // 2}") for k in range(60)] + [(100 + k, f"c{k}", "z") for k in range(3)]
    seen_c, seen_b, want = set(), set(), []
    for i, c, b in rows:
        if c not in seen_c and b not in seen_b:
            want.append(i)
            seen_c.add(c)
            seen_b.add(b)
    df = spark.createDataFrame(rows, "id bigint, c string, b string")
    for most in (2, 200):
        assert sorted(r.id for r in greedy_two_key(df, "id", "c", ["b"], max_rounds=most).collect()) == want


def test_tool_rows(spark):
    from quernix.plans.tool_build import build_tool_rows

    ok = [("system", "s"), ("user", "u"), ("assistant", "bad"), ("user", "Format error: no call"), ("assistant", "run ls\n</parameter>\n"), ("tool", "files"), ("assistant", "done</think>\n")]
    talks = {"ok": ok, "two": [*ok, ("user", "again")], "tags": [*ok[:3], ("assistant", "a</think>b")], "literal": [("system", "s"), ("user", "<|im_end|>"), ("assistant", "a")], "empty": [], "null": None}
    df = spark.createDataFrame(list(talks.items()), "k string, messages array<struct<role: string, content: string>>")
    got = {r.k: r for r in build_tool_rows(df, system="S").collect()}
    assert {k: r.drop_reason for k, r in got.items()} == {"ok": None, "two": "not_one_user_turn", "tags": "stray_reasoning_tags", "literal": "control_literal", "empty": "empty_conversation", "null": "empty_conversation"}
    r = got["ok"]
    assert [tuple(m) for m in r.messages] == [("system", "S"), ("user", "u"), ("assistant", "<think>\n\n</think>\n\nrun ls"), ("user", "<tool_response>\nfiles\n</tool_response>"), ("assistant", "<think>\n\n</think>\n\ndone")]
    from quernix.functions.tokens import DEFAULT_TOKENIZER, tokenizer as library

    text = "".join(f"<|im_start|>{m.role}\n{m.content}<|im_end|>\n" for m in r.messages)
    assert r.input_ids == library(DEFAULT_TOKENIZER).encode(text, add_special_tokens=False).ids
    assert r.removed_turns == 1 and r.n_tokens == len(r.input_ids) == len(r.loss_mask) > sum(r.loss_mask) > 0 and got["null"].input_ids == []
    assert {r.drop_reason for r in build_tool_rows(df.where("k = 'ok'"), max_tokens=3).collect()} == {"too_long"}
