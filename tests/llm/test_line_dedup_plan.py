"""The postings of line dedup are shuffled by token once, not aggregated and joined back."""

from curbstar.llm import line_dedup


def test_postings_are_shuffled_once(spark, monkeypatch):
    seen = {}
    real = line_dedup.stored

    def capture(df, purpose):
        if purpose == "line-postings":
            df.collect()
            seen["plan"] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, purpose)

    monkeypatch.setattr(line_dedup, "stored", capture)
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "a b c d e f g h x y"), (4, "q r s")]
    removed = {(r["doc_id"], r["removed"]) for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert removed == {(1, ""), (2, "0"), (3, ""), (4, "")}
    plan = seen["plan"].split("== Initial Plan ==")[0]
    assert plan.count("hashpartitioning(token") == 1, plan
    assert "SortAggregate" not in plan, plan
    shuffled = plan.split("Exchange hashpartitioning(token")[1].split("\n")[1]
    assert "struct(" not in shuffled, plan
