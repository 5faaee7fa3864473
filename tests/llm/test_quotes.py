import duckdb

from checks.compare import differences
from strata.llm.queries import ORACLES
from strata.llm.quotes import link_quotes

ROWS = [
    (1, 0, "user", "Hello there\nhow are you?"),
    (1, 1, "assistant", "> hello   THERE\n> how are you?\n\nFine."),
    (1, 2, "user", ">> Hello there\n>> how are you?\n> Fine.\nGood to hear"),
    (1, 3, "user", "> Good to hear\n yes"),
    (1, 4, "x", "> nothing known\nok"),
    (1, 5, "x", None),
    (1, 6, "x", "> Good to hear\n> \n> yes\n> nothing"),
    (2, 0, "user", ""),
    (2, 1, "a", "> Fine."),
    (None, 0, "u", "> a"),
    (3, None, "u", "> a"),
    (1, 0, "user", "Hello there\nhow are you?"),
    (4, 0, "u", "same"),
    (4, 1, "u", "same"),
    (4, 2, "u", "> same\r\nreply\n> > deep\n"),
    (4, 3, "q", "deep"),
    (4, 4, "q", " > > reply\n"),
    (5, 0, "u", "long " * 20_000),
    (5, 1, "u", "> " + "long " * 20_000 + "\n>> \t> x"),
]
KIND = "conv_id bigint, turn bigint, role string, text string"


def linked(spark, rows):
    wide = spark.createDataFrame([(*r, "m", 1) for r in rows], KIND + ", message string, h1 int")
    return link_quotes(wide)


def test_links_equal_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    assert differences(linked(spark, ROWS), con, ORACLES["op4_quotation_linking"]) == []


def test_replies_are_threaded(spark):
    found = {(r["conv_id"], r["turn"]): r for r in linked(spark, ROWS).collect()}
    assert [found[1, t]["reply_to"] for t in range(1, 5)] == [0, 1, 2, None]
    assert [found[1, t]["depth"] for t in range(5)] == [0, 1, 2, 3, 0]
    assert found[1, 2]["text"] == "Good to hear" and found[1, 2]["n_quotes"] == 2
    assert found[4, 4]["reply_to"] == 2 and found[4, 4]["text"] == ""
    assert found[4, 2]["n_linked"] == 1  # the deep passage is only written later
    assert found[1, 5]["text"] is None and found[2, 0]["text"] == ""


def test_long_chains_take_few_rounds(spark):
    rows = [(1, 0, "u", "m0")] + [(1, i, "u", f"> m{i - 1}\nm{i}") for i in range(1, 60)]
    found = linked(spark, rows).orderBy("position").collect()
    assert [r["turn"] for r in found] == [r["depth"] for r in found] == list(range(60))
    assert {r["thread"] for r in found} == {0}


def test_empty_table(spark):
    assert linked(spark, ROWS).where("1 = 0").count() == 0
    assert link_quotes(spark.createDataFrame([], KIND)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = linked(spark, ROWS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_part_of_a_passage_is_linked_by_its_lines(spark):
    rows = [
        (1, 1, "a", "First point here\nSecond  point here\nCommon line"),
        (1, 2, "b", "> second point HERE\nI agree."),
        (1, 3, "c", "Common line\nOther thing\nThird thing"),
        (1, 4, "d", "> Common line\n> Other thing\nAnd yet"),
        (1, 5, "e", "> Third thing\n>\n> nothing like it\nNo"),
        (1, 6, "f", "> Later words\nToo early"),
        (1, 7, "g", "Later words\nand more"),
        (2, 1, "h", "> second point here"),
        (1, None, "i", "> second point here"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {(r["conv_id"], r["role"]): (r["n_quotes"], r["n_linked"], r["reply_to"]) for r in link_quotes(df).collect()}
    assert found[1, "b"] == (1, 1, 1)
    # One line of it stands in turn 1 and in turn 3 first, one each: the latest counts.
    assert found[1, "d"] == (1, 1, 3)
    assert found[1, "e"] == (2, 1, 3)
    assert found[1, "f"] == (1, 0, None)
    assert found[2, "h"] == (1, 0, None)
    assert found[1, "i"] == (0, 0, None)
