from fixtures import ALNUM, documents, low

from flightmarts.llm import license_scan as ls


def brute(text):
    w, places, labels = ALNUM.findall(low(text)), [], set()
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    None, "", "mit", "cc by nc", "x cc  by. nc", "Under the MIT license, under  THE mit LICENSE; cc by nc cc by nc.", "under the MİT license", "under the mit licenses",
    "Licensed under the Apache License, Version 2.0.", "cc by " * 20_000 + "nc", "This work is licensed under the GNU General Public License, version 3.",
    "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and its associated documentation files (the Software), to deal in it",
    "permission is hereby granted and nothing else of that notice follows", "under the", "KELVIN",
]


def test_base_counts_equal_brute_force_and_notices_add_labels(spark):
    df = documents(spark, TEXTS, [(3, "cc by nc"), (None, "cc by nc")]).withColumnRenamed("lang", "labels")
    got = ls.scan(df).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None else "cc by nc"
        assert tuple(r)[1:6] == brute(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[10]["labels"] == "gpl-3" and by_id[11]["labels"] == "mit" and 0.6 <= by_id[11]["score"] < 1
    assert by_id[12]["labels"] == "" and by_id[8]["base_labels"] == "apache-2" and by_id[8]["score"] == 1
    assert ls.scan(df.where("false")).collect() == []


def test_spans_and_neighbouring_diagonals(spark):
    notice = next(n for n, label in ls.NOTICES if label == "bsd").split()
    changed = ["x"] * 5 + notice[:8] + ["really"] + notice[8:] + ["y"]
    spans = ls.find_spans(documents(spark, [" ".join(changed)])).collect()
    assert [(s["label"], s["first_word"], s["last_word"]) for s in spans] == [("bsd", 5, 5 + len(notice))]


def test_plan_has_no_python(spark):
    plan = ls.scan(documents(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
