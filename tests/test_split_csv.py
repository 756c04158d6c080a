"""Quoted CSV in splits: the lines stay in the tasks that read them."""

from mailsieve.sources import split_csv


def test_lines_are_not_shuffled(spark, tmp_path, monkeypatch):
    plans = {}
    true = split_csv.written

    def planned(frame, name):
        plans[name] = frame._jdf.queryExecution().executedPlan().toString()
        return true(frame, name)

    monkeypatch.setattr(split_csv, "written", planned)
    (tmp_path / "a.csv").write_text('n,text\n' + "".join(f'{i},"one\n{i} ""two"""\n' for i in range(3000)))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = {r["n"]: r["text"] for r in split_csv.read_split_csv(spark, str(tmp_path / "a.csv")).collect()}
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert found == {str(i): f'one\n{i} "two"' for i in range(3000)}
    assert "Exchange hashpartitioning" not in plans["csv-records"] and "SortMergeJoin" not in plans["csv-records"]
