import hashlib
import json
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text as tx
from tidewatch.filters import key_filter, passing
from tidewatch.operators import audit, dlq, evalrun, generate, leak, records, split, stats
from tidewatch.plans import catalog
from tidewatch.sources import files, sinks
from tidewatch.tables import ranked


def col(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


def test_text(spark):
    assert col(spark, ["a (Citation: X 1) [b](https://c.d/e)  f ", None], tx.clean_text) == ["a b f", ""]
    assert col(spark, ["one two three", "onetwothree", "short"], lambda c: tx.truncate(c, 9)) == ["one two…", "onetwoth…", "short"]
    assert col(spark, ["x T1059.001 T10590 T1003"], tx.redact_techniques) == ["x [redacted] T10590 [redacted]"]
    assert col(spark, ["a\nb\n", ""], tx.indent) == ["  a\n  b", ""]
    assert col(spark, ["q<answer>\n {x} </answer><answer>y</answer>", "none"], lambda c: tx.tagged(c, "answer")) == ["{x}", None]
    assert col(spark, ["It's ÉA-b 9x"], tx.word_tokens) == [["it's", "a-b", "x"]]
    assert col(spark, ["```json\n{}\n```", "plain"], tx.without_fence) == ["{}", "plain"]
    assert col(spark, ["<think>a\nb</think> c"], tx.without_reasoning_channel) == ["c"]
    assert col(spark, ["accounts/a/deployments/d1", "d2"], lambda c: tx.resource_tail(c, "deployments")) == ["d1", "d2"]
    assert col(spark, ["Image|endswith"], tx.base_field) == ["Image"]
    assert col(spark, ["a b c d", "a"], lambda c: tx.shingles(F.split(c, " "), 3)) == [["a b c", "b c d"], []]


def record(user="u", answer='{"summary":1,"evidence":1,"hypotheses":1,"actions":1}', book="good", ids=("mitre-T1059",), **meta):
    m = {"task": "t", "source_ids": list(ids), "source_book": book, "split": "train", "synthesized": True} | meta
    return json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": user}, {"role": "assistant", "content": f"<reasoning>why</reasoning>\n<answer>{answer}</answer>"}], "meta": m})


@pytest.fixture
def lines(spark, tmp_path):
    bad_roles = json.loads(record("r"))
    bad_roles["messages"][0]["role"] = "user"
    rows = [record(), "", "{bad", json.dumps({"messages": []}), record("u", ids=("odd id",)), record("x", '{"summary":1', split="eval"), json.dumps(bad_roles), record("see the passage says", "[1]", book="other"), json.dumps({"messages": json.loads(record("z"))["messages"], "meta": 3})]
    (tmp_path / "good.jsonl").write_text("\n".join(rows))
    return files.numbered_lines(spark, str(tmp_path))


def codes(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.line, set()).add(f"{r.code}:{r.detail}" if r.detail else r.code)
    return out


def test_audits(lines):
    parsed = audit.parse(lines).cache()
    assert sorted(r.line for r in parsed.select("line").collect()) == [1, 3, 4, 5, 6, 7, 8, 9]
    basic = codes(audit.basic_audit(parsed))
    assert basic == {3: {"json"}, 4: {"messages"}, 7: {"roles:user,user,assistant"}, 9: {"meta"}}
    checks = (*audit.STRICT, audit.short_reasoning(10), audit.core_keys(), audit.phrases(audit.PHRASES_STRICT), *audit.id_styles(audit.STYLES_STRICT))
    got = codes(audit.strict_audit(parsed, checks, repeats=True))
    short = "reasoning_length:3"
    assert got[1] == {short} and got[3] == {"json"} and got[4] == {"messages"}
    assert got[5] == {short, "source_id_style:odd id", "repeated_prompt:good.jsonl:1", "repeated_answer:good.jsonl:1"}
    assert got[6] == {short, "answer_json", "split:eval", "repeated_task_sources:good.jsonl:1"}
    assert got[8] == {short, "phrase:the passage says", "source_book:other", "repeated_task_sources:good.jsonl:1"}
    assert got[9] == {short, "meta"}
    rows = audit.audited(parsed, checks)
    counts = audit.report(rows, audit.duplicates(parsed)).first()
    assert (counts.total_lines, counts.valid_records, counts.issues) == (8, 5, sum(map(len, got.values())))
    assert set(codes(audit.range_audit(parsed, 3, 4))) == {3, 4}
    errors = {r.location: r.error for r in audit.export_errors(parsed).collect()}
    assert errors == {"good.jsonl:3": "json", "good.jsonl:4": "messages", "good.jsonl:6": "answer_json", "good.jsonl:7": "roles", "good.jsonl:8": "source_book", "good.jsonl:9": "meta"}


def test_audit_of_ids_and_flags_of_other_types(spark):
    rows = [record("a", ids=("mitre-T1059.001", 7, None)), record("b", synthesized="true"), record("c", ids=())]
    parsed = audit.parse(spark.createDataFrame([("good.jsonl", i, v) for i, v in enumerate(rows, 1)], "file string, line int, value string"))
    got = codes(audit.strict_audit(parsed, (*audit.STRICT, *audit.id_styles(audit.STYLES_STRICT))))
    assert got == {1: {"source_id_type:bigint", "source_id_type:void"}, 2: {"synthesized"}, 3: {"source_ids"}}
    assert audit.audited(parsed.limit(0)).count() == 0


def test_export_rows_and_manifest(spark):
    long = "<reasoning>" + "r" * 250 + "</reasoning><answer>{}</answer>"
    ok = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": long}]}
    rows = [json.dumps(ok), json.dumps({"messages": [], "x": 1}), json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "system", "content": "s", "weight": 2}]})]
    got = {r.location: set(r.issues) for r in audit.validate_rows(spark.createDataFrame(list(enumerate(rows)), "location int, value string")).collect()}
    assert got[0] == set()
    assert got[1] == {"messages", "keys:x"}
    assert got[2] == {"weight", "system_first", "no_role:assistant"}
    entries = spark.createDataFrame([("a", 1, "s"), ("b", 2, "s"), ("c", 1, "s")], "file string, records int, sha256 string")
    results = spark.createDataFrame([("a", 1, "s"), ("b", 3, "t"), ("z", 1, "s")], "file string, records int, sha256 string")
    assert sorted((r.file, r.issue) for r in audit.check_manifest(entries, results).collect()) == [("b", "records"), ("b", "sha256"), ("c", "unknown_file")]


def test_leaks(spark):
    words = [f"w{i}" for i in range(40)]
    good, odd = '<reasoning>r</reasoning><answer>{"a": 1}</answer>', "</answer><reasoning></reasoning><answer>{}"
    recs = spark.createDataFrame(
        [("a", " ".join(words[:20]), good, "deep", ["c2", "c1", "c3"], None), ("b", " ".join(words[:6]), good, None, None, "c1"), ("d", "none here", odd, "deep", ["c1"], "c1"), ("e", "W3 w4 w5 w6!", None, "deep", ["gone"], None)],
        "text_id string, text string, answer_text string, synthesis string, source_ids array<string>, source_chunk string",
    )
    chunks = spark.createDataFrame([("c1", " ".join(words[3:35])), ("c2", " ".join(words[5:11])), ("c3", " ".join(words[:40]))], "chunk_id string, text string")
    lcs = {(r.text_id, r.chunk_id): r.lcs for r in leak.longest_common(leak.candidates(recs, chunks)).collect()}
    assert lcs == {("a", "c1"): 17, ("a", "c2"): 6, ("a", "c3"): 20, ("b", "c1"): 0, ("d", "c1"): 0}
    # c1 is the first leak of a; c3, named later, isn't looked at
    seen = {r.text_id: (r.lcs, r.leak_chunk) for r in leak.examined(recs, chunks).collect()}
    assert seen == {"a": (17, "c1"), "b": (0, None), "d": (0, None)}
    one = leak.audit(recs, chunks).first()
    assert one.asDict() == {
        "total": 4, "structurally_valid": 2, "structural_validity_pct": 50.0, "with_source_chunk": 3, "verbatim_leaked": 1, "leak_rate_pct": 33.33,
        "max_lcs_words_observed": 17, "totals_by_synthesis": '{"?":1,"deep":3}', "leaks_by_synthesis": '{"deep":1}',
    }
    none = leak.audit(recs.limit(0), chunks).first()
    assert (none.total, none.leak_rate_pct, none.totals_by_synthesis) == (0, 0.0, "{}")


def test_longest_common_by_brute_force(spark):
    rng = random.Random(3)
    pairs = []
    for i in range(150):
        base = [rng.choice("abcdefgh") for _ in range(60)]
        cut = rng.randrange(0, 30)
        pairs.append((i, " ".join(base), " ".join([rng.choice("xyz") for _ in range(5)] + base[cut : cut + rng.randrange(0, 35)] + ["q"] * 3)))

    def longest(a, b):
        a, b = a.split(), b.split()
        best = 0
        for n in range(4, 26):
            if not {tuple(a[i : i + n]) for i in range(len(a) - n + 1)} & {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}:
                break
            best = n
        return best

    got = {r.i: r.lcs for r in leak.longest_common(spark.createDataFrame(pairs, "i int, text string, chunk string")).collect()}
    assert got == {i: longest(a, b) for i, a, b in pairs}


def test_shared_runs_by_filter_or_broadcast(spark, monkeypatch):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choices("abcd", k=n))
    texts = [(i, text(rng.randrange(0, 60))) for i in range(40)] + [(0, text(30)), (99, None)]
    chunks = [(i, text(rng.randrange(0, 40))) for i in range(20)] + [(7, text(20)), (98, None)]
    runs = lambda t, n=4: {tuple((t or "").split()[i : i + n]) for i in range(len((t or "").split()) - n + 1)}
    by_id = lambda rows: {k: set().union(*(runs(t) for x, t in rows if x == k)) for k, _ in rows}
    want = {(a, b): len(x & y) for a, x in by_id(texts).items() for b, y in by_id(chunks).items() if x & y}
    frames = spark.createDataFrame(texts, "text_id int, text string"), spark.createDataFrame(chunks, "chunk_id int, text string")
    for most in (leak.SMALL_RUNS, 0):
        monkeypatch.setattr(leak, "SMALL_RUNS", most)
        assert {(r.text_id, r.chunk_id): r.n_shared for r in leak.shared_shingles(*frames, 4).collect()} == want
    assert leak.shared_shingles(frames[0], frames[1].limit(0)).count() == 0


def test_filter_has_every_key(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as h")
    bits = key_filter(keys, 5000)
    both = spark.range(10_000).selectExpr("id", "xxhash64(id) as h")
    got = [r.id for r in passing(both, "h", bits).collect()]
    assert set(range(5000)) <= set(got) and len(got) < 5000 + 250


def test_quotas_and_stratified(spark):
    q = split.quotas({"a": 100, "b": 10, "c": 1, "d": 2}, 12, 1)
    assert sum(q.values()) == 12 and q["c"] == 0 and q["d"] == 1 and q["b"] >= 1
    assert split.quotas({"a": 3}, 99) == {"a": 2} and split.quotas({}, 5) == {}
    df = spark.range(113).selectExpr("id", "case when id < 100 then 'a' when id < 110 then 'b' when id < 111 then 'c' else 'd' end as g")
    got = split.stratified_split(df, "g", "id", 7, eval_count=12)
    n = {r.g: r["count"] for r in got.where("split = 'eval'").groupBy("g").count().collect()}
    assert n == {k: v for k, v in q.items() if v} and got.count() == 113


def test_records_and_sinks(spark, tmp_path):
    m = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in (("system", "s"), ("user", "u"), ("assistant", "<reasoning>r</reasoning><answer>{}</answer>"))])
    base = spark.range(1).select(m.alias("messages"))
    moved = base.select(records.export_messages(F.col("messages"), "reasoning_content").alias("m")).first().m[2]
    assert (moved.content, moved.reasoning_content) == ("<answer>{}</answer>", "r")
    with pytest.raises(ValueError):
        records.export_messages(F.col("messages"), "x")
    assert records.with_ids(base).first().id == records.with_ids(base).first().id
    sinks.write_jsonl(base, str(tmp_path / "o"), one_file=True)
    assert files.count_lines(spark, str(tmp_path / "o")) == 1
    assert files.jsonl(spark, str(tmp_path / "none"), "a int", missing_ok=True).count() == 0
    (tmp_path / "t.jsonl").write_text('{"a":1}\n{bad\n\n{"a":2}\n')
    assert files.jsonl_tolerant(spark, str(tmp_path / "t.jsonl"), "a int").count() == 2
    with pytest.raises(Exception):
        files.jsonl(spark, str(tmp_path / "t.jsonl"), "a int").collect()
    rows, missing = files.task_files(spark, str(tmp_path), ["t2"], "a int")
    assert rows.count() == 0 and missing == ["t2"]
    names = spark.createDataFrame([("a.jsonl",), ("fragment_1.jsonl",), ("my_temp.jsonl",), ("x.txt",)], "file string")
    assert [files.without_junk(names, rule=r).count() for r in ("prefix", "part")] == [2, 1]
    assert json.loads(sinks.json_array(spark.range(3), F.col("id")).first().value) == [{"id": 0}, {"id": 1}, {"id": 2}]
    assert stats.task_totals(spark.createDataFrame([("a", 3), ("a", 4), (None, 1)], "task string, n_tokens int")).where("task = 'TOTAL'").first().tokens == 8


def test_model_calls_are_rows(spark):
    cases = spark.createDataFrame([("c1", "p")], "case_id string, prompt string")
    good = evalrun.run_model(cases, "prompt", lambda p: p + "!").first()
    assert (good.content, good.error) == ("p!", None)

    def fail(_: pd.Series) -> pd.Series:
        raise RuntimeError("no model")

    assert evalrun.run_model(cases, "prompt", fail).first().error == "no model"


def test_generators(spark):
    tech = [{"id": "T1059", "name": "Shell", "description": "Runs commands.", "detection": "Look.", "platforms": ["Linux"], "tactics": [{"name": "Execution", "short_name": "execution"}],
             "detection_strategy": {"id": "DS1", "analytics": [{"id": "A1", "description": "An", "platforms": ["Linux"], "log_sources": [{"name": "auditd"}]}]},
             "mitigations": [{"id": "M1", "name": "Mit", "note": ""}], "procedure_examples": [{"procedure": "The group ran T1059 with " + "x " * 20, "actor_id": "G1", "actor_name": "Gr", "actor_type": "intrusion-set"}]}]
    rules = [{"rule_id": "r1", "title": "Rule", "description": "Finds", "level": "medium", "detection_yaml": "selection:\n  Image|endswith: nc\n  CommandLine: -l\ncondition: selection", "logsource": {"product": "windows", "category": "process_creation", "service": None}, "mitre_techniques": ["T1059", "T1"]},
             {"rule_id": "r2", "title": "Bad", "description": "x", "level": None, "detection_yaml": ": : [", "logsource": {"product": "linux", "category": None, "service": None}, "mitre_techniques": ["T9"]}]
    sysmon = [{"event_id": 1, "event_name": "ProcessCreate", "action": "include", "field": "Image", "condition": "end with", "value": "nc.exe", "section": None, "comment": "A long enough note", "mitre_techniques": ["T1059"]},
              {"event_id": 9, "event_name": "RawAccess", "action": "include", "field": "Device", "condition": "is", "value": "d", "section": "s", "comment": "Another long note here", "mitre_techniques": ["T1059"]}]
    read = lambda rows, schema: spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    analytic = "struct<id:string,description:string,platforms:array<string>,log_sources:array<struct<name:string>>>"
    tables = {
        "techniques": read(tech, f"id string, name string, description string, detection string, platforms array<string>, tactics array<struct<name:string,short_name:string>>, detection_strategy struct<id:string,analytics:array<{analytic}>>, mitigations array<struct<id:string,name:string,note:string>>, procedure_examples array<struct<procedure:string,actor_id:string,actor_name:string,actor_type:string>>"),
        "rules": read(rules, "rule_id string, title string, description string, level string, detection_yaml string, logsource struct<product:string,category:string,service:string>, mitre_techniques array<string>"),
        "sysmon": read(sysmon, "event_id int, event_name string, action string, field string, condition string, value string, section string, comment string, mitre_techniques array<string>"),
        "mitigations": spark.createDataFrame([("M1", "Full text")], "id string, description string"),
    }
    rows = generate.build(tables).collect()
    by = {}
    for r in rows:
        by.setdefault(r.meta.task, []).append(r)
        assert [m.role for m in r.messages] == ["system", "user", "assistant"]
        json.loads(r.messages[2].content.split("<answer>")[1].split("</answer>")[0])
    assert {k: len(v) for k, v in by.items()} == {"technique_explanation": 1, "procedure_to_technique": 1, "sigma_to_technique": 1, "technique_to_detection": 1, "sysmon_rationale": 2, "event_to_technique": 3, "mitigation_recommend": 1}
    assert "T1059" not in by["procedure_to_technique"][0].messages[1].content
    assert "Full text" in by["mitigation_recommend"][0].messages[2].content
    event = json.loads(generate.rule_events(tables["rules"]).first().event)
    assert event["fields"] == {"Image": "nc", "CommandLine": "-l"} and event["event_id"] == 1


def test_word_tokens_of_whole_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        w = [x.lower() for x in re.findall(r"[A-Za-z][A-Za-z0-9_'\-]*", r.text)]
        want[r.doc_id] = (len(w), hashlib.sha256(" ".join(w).encode()).hexdigest())
    got = catalog.QUERIES["word_tokens_whole"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_words, r.words_sha256) for r in got} == want


def test_every_case_for_over_a_thousand_models(spark):
    models = spark.range(1500).selectExpr("concat('m', id) as label")
    got = evalrun.model_cases(models, spark.range(2).selectExpr("id as item_id"))
    assert got.columns == ["item_id", "label"]
    assert got.distinct().count() == 3000
    assert evalrun.model_cases(models.limit(0), spark.range(2)).count() == 0


def test_splits_by_keys_that_repeat(spark):
    from hashlib import md5

    df = spark.createDataFrame([(k % 100, k) for k in range(200)] + [(None, 1000)], "k long, n long")
    order = sorted(range(100), key=lambda k: (md5(f"3:{k}".encode()).hexdigest(), k))
    got = {r.n: r.split for r in split.ratio_split(df, "k", 3, 0.1).collect()}
    assert got == {n: "train" if n % 100 in order[:90] else "eval" for n in range(200)} | {1000: "eval"}
    got = {r.n: r.split for r in split.holdout(df, "k", 3, least=7, share=20).collect()}
    assert got == {n: "eval" if n % 100 in order[:7] else "train" for n in range(200)} | {1000: "train"}
    assert {r.split for r in split.holdout(df.where("k < 3"), "k", 3).collect()} == {"eval"}
    assert split.ratio_split(df.limit(0), "k", 3, 0.1).count() == 0


def test_templates_are_filled_in_one_pass(spark):
    row = spark.range(1).select(
        tx.filled(F.lit("a {x} b {y}{x} {z} }{"), x=F.lit("{y}"), y=F.lit("$1\\ {x}")).alias("a"),
        tx.filled(F.lit(""), x=F.lit("v")).alias("b"), tx.filled(F.lit("{x}"), x=F.lit(None).cast("string")).alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == ("a {y} b $1\\ {x}{y} {z} }{", "", "")


def test_every_model_is_crossed(spark):
    models = spark.range(1500).selectExpr("cast(id as string) as label")
    assert evalrun.model_cases(models, spark.createDataFrame([(1,), (2,)], "c int")).distinct().count() == 3000


def test_line_numbers_of_a_file_in_many_blocks(spark, tmp_path):
    rng = random.Random(8)
    texts = {f"f{k}.jsonl": ["" if rng.random() < 0.2 else " x" * rng.randrange(0, 200) + str(i) for i in range((1, 40, 900, 901)[k])] for k in range(4)}
    for name, rows in texts.items():
        (tmp_path / name).write_text("\n".join(rows) + ("\n" if len(rows) % 2 else ""))
    keys = {"spark.sql.files.maxPartitionBytes": "7000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = {(r.file, r.line): r.value for r in files.numbered_lines(spark, str(tmp_path)).collect()}
        every = files.numbered_lines(spark, str(tmp_path), blank=True).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(f, i): v.strip() for f, rows in texts.items() for i, v in enumerate(rows, 1) if v.strip()}
    assert every == sum(len(r) - (r[-1] == "" and len(r) % 2 == 0) for r in texts.values())


def test_ranks_without_a_global_window(spark):
    keys = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4000"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("h"))
        got = {r.id: r.rank for r in ranked(df, [F.col("h"), F.col("id")]).collect()}
        assert ranked(df.limit(0), [F.col("id")]).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: r for r, (_, i) in enumerate(sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i in range(5000)), 1)}


def test_quotas_of_many_groups(spark, monkeypatch):
    monkeypatch.setattr(split, "RANK_BLOCK", 7)
    rng = random.Random(2)
    for trial in range(10):
        sizes = {f"g{i:03d}": rng.choice([1, 1, 2, 3, rng.randrange(1, 400)]) for i in range(rng.choice([1, 5, 60]))}
        wanted, least = rng.randrange(0, sum(sizes.values()) + 5), rng.choice([0, 1, 3])
        frame = spark.createDataFrame(list(sizes.items()), "g string, n long")
        got = {r.g: r.quota for r in split.group_quotas(frame, "g", wanted, least).collect()}
        assert got == split.quotas(sizes, wanted, least), (trial, wanted, least)


def test_quotas_of_a_quarter_million_groups(spark):
    sizes = spark.range(250_000).select(F.col("id").alias("g"), (F.col("id") % 7 + 1).alias("n"))
    for least in (0, 1):
        got = split.group_quotas(sizes, "g", 50_000, least).agg(F.sum("quota").alias("s"), F.count_if(F.col("quota") > F.col("n") - 1).alias("over"), F.count("*").alias("n")).first()
        assert (got.s, got.over, got.n) == (50_000, 0, 250_000)


def test_cases_are_loaded_by_contract(spark, tmp_path):
    def case(n, **more):
        return {"messages": [{"role": r, "content": f"{r} {n} é/\\"} for r in ("system", "user", "assistant")], "meta": {"task": "t", "source_ids": ["a"]}} | more

    (tmp_path / "ok.jsonl").write_text("\n".join(["", *[json.dumps(case(n)) for n in range(9)], "", json.dumps(case(9, meta=None))]))
    lines = files.numbered_lines(spark, str(tmp_path / "ok.jsonl"))
    rows = evalrun.load_cases(lines, 100, 1).collect()
    assert [r.line for r in rows] == [*range(2, 11), 12] and rows[-1].source_ids == [] and rows[0].source_ids == ["a"]
    prompt = json.dumps([{"content": m["content"], "role": m["role"]} for m in case(0)["messages"][:2]], ensure_ascii=False, sort_keys=True)
    assert rows[0].case_id == f"ok.jsonl:2:{hashlib.sha256(prompt.encode()).hexdigest()[:16]}"
    some = [r.line for r in evalrun.load_cases(lines, 4, 7).collect()]
    assert len(some) == 4 and some == sorted(some) == [r.line for r in evalrun.load_cases(lines, 4, 7).collect()]
    with pytest.raises(ValueError, match="limit"):
        evalrun.load_cases(lines, 0, 1)
    two = case(1)
    two["messages"] = two["messages"][:2]
    blank = case(1)
    blank["messages"][1]["content"] = " "
    for bad, why in (("{x", "json"), (json.dumps(case(1, messages=3)), "messages"), (json.dumps(two), "message 2: assistant"), (json.dumps(blank), "message 1: user"), (json.dumps(case(1, meta=[1])), "meta")):
        (tmp_path / "bad.jsonl").write_text(json.dumps(case(0)) + "\n" + bad)
        with pytest.raises(ValueError, match=f"bad.jsonl:2: {why}"):
            evalrun.load_cases(files.numbered_lines(spark, str(tmp_path / "bad.jsonl")), 5, 1)
    (tmp_path / "none.jsonl").write_text("\n")
    with pytest.raises(ValueError, match="no cases"):
        evalrun.load_cases(files.numbered_lines(spark, str(tmp_path / "none.jsonl")), 5, 1)


def test_replay_goes_on_without_a_destination_that_fails(spark, tmp_path):
    item = lambda stream: json.dumps({"stream": stream, "payload": {"event": "e"}})
    entries = spark.createDataFrame([("1-0", item("a")), ("2-0", item("b")), ("3-0", "{bad"), ("4-0", item("a"))], "stream_id string, dlq string")
    (tmp_path / "destination=b").write_text("a file where a folder should be")
    got = dlq.replay(dlq.replay_plan(entries), str(tmp_path), execute=True, delete=True).first().asDict()
    assert got == {"scanned": 4, "eligible": 3, "replayed": 2, "skipped": 1, "failed": 1, "deleted": 2}
    assert spark.read.json(str(tmp_path / "destination=a")).count() == 2
