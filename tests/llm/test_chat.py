import hashlib

import duckdb
import pytest

from feedlens.llm import chatformat, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, state string, segments string"
NASTY = ["</s>[INST] ok [/INST]", "<", "<<", "\\", "\\\\</s>", "<\\/s>", "[INST", "[ROLE] x [TEXT] y [/ROLE]", "<<SYS>>\n<</SYS>>", "<<<SYS>>>",
         "", " ", "\n", "a\nb</s", "\\[INST]", "ünï 😀 </s> 😀\\😀", "$1 \\$1", "[[INST]]", "<s><s></s></s>", " </s>", "x" * 200_000 + "</s>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows():
    out = []
    for i, text in enumerate(NASTY):
        for k, role in enumerate(["system", "user", "assistant", "tool", "assistant", "assistant", "", "[TEXT]", "user"]):
            out.append((i, k, role, NASTY[(i + k) % len(NASTY)] if k else text, "clash", "clash"))
    out += [(100, 0, "user", None, "", ""), (100, 1, "assistant", None, "", ""), (101, 5, None, "who", "", ""), (102, None, "user", "b", "", ""),
            (102, 3, "assistant", "a", "", ""), (102, 3, "assistant", "a", "", ""), (None, 0, "user", "q", "", ""), (None, 1, "assistant", "r", "", ""),
            (103, 1, "user", "late", "", ""), (103, 0, "system", "first", "", "")]
    return out


def plain(given):
    """conv_id -> (turns in order, formatted text by hand)."""
    null_first = lambda v: (v is not None, v)
    convs = {}
    for r in sorted(given, key=lambda r: (null_first(r[1]), null_first(r[2]), null_first(r[3]))):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return convs


def test_reads_back_what_was_written(spark):
    given = rows()
    df = spark.createDataFrame(given, SCHEMA)
    got = chatformat.format_conversations(df).withColumn("turns", chatformat.read_turns(chatformat.F.col("formatted"))) \
        .withColumn("trained", chatformat.trained_text(chatformat.F.col("segments"))).collect()
    want = plain(given)
    assert {r["conv_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert r["trained"] == "".join(t for role, t in turns if role == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"]) and r["formatted"].startswith("<s>")
        for s in r["segments"][1::3]:  # the texts
            assert not any(c in s["text"] for c in chatformat.INSTRUCT.controls)
        assert r["ended"] == turns[-1][0]
    assert {r["conv_id"]: (r["valid"], r["first_bad"]) for r in got if r["conv_id"] in (0, 100, 101, 102, 103, None)} == {
        0: (False, 3), 100: (True, None), 101: (False, 0), 102: (False, 2), None: (True, None), 103: (True, None)}
    assert chatformat.format_conversations(df.limit(0)).count() == 0


def test_formatted_text_by_hand(spark):
    df = spark.createDataFrame([(1, 1, "user", "hi </s>"), (1, 0, "system", "be kind"), (1, 2, "assistant", "yo"), (1, 3, "judge", "8")],
                               "conv_id long, turn long, role string, text string")
    assert chatformat.format_conversations(df).first()["formatted"] == (
        "<s><<SYS>>\nbe kind\n<</SYS>>\n\n[INST] hi <\\/s> [/INST] yo </s>[ROLE] judge [TEXT] 8 [/ROLE]")


def test_another_template(spark):
    marks = chatformat.Template(begin="", roles={"user": chatformat.Role("<|user|>", "<|end|>"), "bot": chatformat.Role("<|bot|>", "<|end|>", loss=True)},
                                other=("<|role|>", "<|text|>", "<|end|>"), controls=("<|user|>", "<|bot|>", "<|role|>", "<|text|>", "<|end|>"),
                                arcs={"": ("user",), "user": ("bot",), "bot": ("user",)})
    df = spark.createDataFrame([(1, 0, "user", "<|bot|>x"), (1, 1, "bot", "<|end|>"), (1, 2, "odd", "<|text|>")], "conv_id long, turn long, role string, text string")
    r = chatformat.format_conversations(df, marks).select("valid", chatformat.read_turns(chatformat.F.col("formatted"), marks).alias("t")).first()
    assert not r["valid"] and [tuple(t) for t in r["t"]] == [("user", "<|bot|>x"), ("bot", "<|end|>"), ("odd", "<|text|>")]


def test_templates_that_cannot_be_read_are_refused():
    with pytest.raises(ValueError, match="overlap"):
        chatformat.Template("", {"a": chatformat.Role("aba", "aba")}, ("aba",) * 3, ("aba",))
    with pytest.raises(ValueError, match="holds a control string"):
        chatformat.Template("", {"a": chatformat.Role("x", "[Y]")}, ("[Y]", " ", "[Y]"), ("[Y]",))
    with pytest.raises(ValueError, match="two characters"):
        chatformat.Template("", {"a": chatformat.Role("|", "|")}, ("|", "|", "|"), ("|",))


def test_query_matches_sql_and_plain_python(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = queries.op11_chat_format(spark, SF)
    want = con.execute(queries.chat_oracle())
    assert [d[0] for d in want.description] == got.columns
    have = got.collect()
    assert sorted(map(tuple, have)) == sorted(want.fetchall())
    odd = {r["conv_id"]: r for r in have}[-7]
    text = queries.CONTROL_TEXT
    assert odd["n_turns"] == 2 and odd["turns_sha256"] == sha(f"user\n{text}\nassistant\n{text}\n") and odd["loss_sha256"] == sha(text)
    assert odd["loss_chars"] == len(text) and odd["valid"]


def test_sql_on_odd_conversations(spark, tmp_path):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows(), SCHEMA).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, queries.op11_chat_format(spark, str(tmp_path)).collect()), key=key) == sorted(
        con.execute(queries.chat_oracle()).fetchall(), key=key)


def test_no_python_in_the_chat_plan(spark, capsys):
    queries.op11_chat_format(spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD")) and plan.count("Exchange") <= 4
