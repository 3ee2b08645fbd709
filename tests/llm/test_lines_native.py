"""Line deduplication without Python on the executors."""

from sahaf.llm import lines


def test_lines_are_cut_and_listed_without_python(spark, monkeypatch):
    """Blanks of any kind part words alike; copies beyond the most frequent lines are found as well."""

    def refused(*_, **__):
        raise AssertionError("runs Python on the executors")

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", refused)
    monkeypatch.setattr(lines, "OFTEN", 1)
    words = [f"w{x}" for x in range(30)]
    plain, odd = " ".join(words), "\t" + " \x0b ".join(words).upper() + "\r\x0c"
    near = " ".join([*words[:-1], "other"])
    rows = [(0, f"{plain}\nown line of zero\n\nshort"), (1, f"short\n{odd}"), (2, f"{near}\nshort\nown line of two"), (3, None), (None, "short\n" + plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.text, r.lost) for r in lines.without_repeats(docs, removed="lost").collect()}
    assert out == {0: (rows[0][1], 0), 1: ("", 2), 2: ("own line of two", 2), 3: (None, 0), None: ("", 2)}
