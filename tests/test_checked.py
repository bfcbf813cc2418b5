import pytest

from lumenfold.sources import checked
from lumenfold.streaming import durable


def write(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


LINES = ["t1,m,u1,5.5", "t2,m,u2,n/a", "t3,m", "", "t4,m,u4,", "t5,m,u5,1,extra", 't6,"a,b",u6,-2e3', "t7,m,,4", "   ", "t8,m,u8,7"]
GOOD = [("t1", "m", "u1", 5.5), ("t6", "a,b", "u6", -2000.0), ("t8", "m", "u8", 7.0)]
BAD = [("t2,m,u2,n/a", "unreadable"), ("t3,m", "unreadable"), ("t4,m,u4,", "no amount"), ("t5,m,u5,1,extra", "unreadable"), ("t7,m,,4", "no user_id")]


def both(found):
    return sorted(map(tuple, found.good.collect())), sorted((r["line"], r["reason"]) for r in found.bad.collect())


def test_every_transaction_line_is_good_or_bad(spark, tmp_path):
    write(tmp_path / "in", "a.csv", LINES)
    found = checked.check_transactions(spark, str(tmp_path / "in"))
    assert both(found) == (GOOD, BAD)
    assert {r["file"].rsplit("/", 1)[1] for r in found.bad.collect()} == {"a.csv"}
    assert {r["reason"]: r["lines"] for r in found.counts().collect()} == {None: 3, "unreadable": 3, "no amount": 1, "no user_id": 1}


def test_without_required_values_only_unreadable_lines_are_bad(spark, tmp_path):
    write(tmp_path / "in", "a.csv", LINES)
    found = checked.check_transactions(spark, str(tmp_path / "in"), required=())
    assert {r["reason"] for r in found.bad.collect()} == {"unreadable"} and found.good.count() == 5


def test_an_empty_file_has_no_lines(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [])
    assert both(checked.check_transactions(spark, str(tmp_path / "in"))) == ([], [])


def test_json_lines(spark, tmp_path):
    lines = ['{"reviewerID":"r1","overall":5,"verified":true}', "{broken", '{"overall":"five"}', "[1]", "null", '{"reviewText":"x","more":1}']
    write(tmp_path / "in", "a.json", lines)
    found = checked.check_reviews(spark, str(tmp_path / "in"))
    assert sorted((r["reviewerID"], r["reviewText"], r["overall"]) for r in found.good.collect() if r["reviewerID"]) == [("r1", None, 5.0)]
    assert found.good.count() == 2
    assert sorted(r["line"] for r in found.bad.collect()) == sorted(["{broken", '{"overall":"five"}', "[1]", "null"])
    assert checked.check_reviews(spark, str(tmp_path / "in"), required=["overall"]).bad.where("reason = 'no overall'").count() == 1


def test_numbers_with_a_header(spark, tmp_path):
    write(tmp_path / "in", "a.csv", ["x,y", "1,2", "1,two", "3", "4,"])
    found = checked.check_numeric_csv(spark, str(tmp_path / "in"), ["x", "y"], required=["y"])
    good, bad = both(found)
    assert good == [(1.0, 2.0)] and sorted(reason for _, reason in bad) == ["no y", "unreadable", "unreadable"]
    assert {"1,two", "3"} <= {line for line, _ in bad}
    with pytest.raises(Exception, match="CSV header does not conform"):
        checked.check_numeric_csv(spark, str(tmp_path / "in"), ["x", "z"]).good.collect()


def test_stream_of_lines_to_two_outputs(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.csv", LINES[:5])
    write(source, "b.csv", LINES[5:])

    def run():
        stream = checked.checked_transaction_stream(spark, str(source), files_per_batch=1)
        return durable.write_checked(stream, checked.TRANSACTIONS.names, str(tmp_path / "out"), str(tmp_path / "state"))

    assert both(run()) == (GOOD, BAD)
    write(source, "c.csv", ["t9,m,u9,9", "junk"])
    assert both(run()) == (sorted([*GOOD, ("t9", "m", "u9", 9.0)]), sorted([*BAD, ("junk", "unreadable")]))
