from __future__ import annotations

import csv
import glob
import json
import random

from loomwork.jobs import main


def output(path: str) -> list[str]:
    return [line.rstrip("\n") for part in sorted(glob.glob(f"{path}/part-*")) for line in open(part, encoding="utf-8")]


def test_common_words(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    main(["common-words", lines("a", "the cat, cat", "It sat"), lines("b", "cat It", "the It"), lines("s", "the"), out])
    assert output(out) == ["1\tIt", "1\tcat"]


def test_recommend(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    main(["recommend", lines("r", "1,10,0", "2,10,4", "2,11,4", "bad"), out, "--malformed", "skip"])
    assert output(out) == ["1\t11,0.0"]


def test_forum(spark, lines, tmp_path):
    rng = random.Random(1)
    questions = [f"1,{i},,0,{rng.choice(['Algorithm', 'Security', 'Unlisted'])}" for i in range(60)]
    answers = [f"2,{100 + i},{i % 60},{rng.randrange(-5, 40)}" for i in range(180)]
    out = str(tmp_path / "out")
    main(["forum", lines("p", *questions, *answers), out, "--k", "6"])
    report = list(csv.DictReader(output(out)))
    assert sum(int(r["size"]) for r in report) == 60
    assert [int(r["avg"]) for r in report] == sorted(int(r["avg"]) for r in report)
    assert {r["domain"] for r in report} <= {"", "Algorithm", "Security", "Machine-Learning", "Compute-Science",
                                             "Big-Data", "Data-Analysis"}


def test_texts(spark, lines, tmp_path):
    texts = [f'0,{i},d,q,u,"{t}"' for i, t in enumerate(["good day, sun", "bad night moon"] * 10)]
    out = str(tmp_path / "out")
    main(["texts", lines("t", *texts), lines("s", "day"), out, "--vector-size", "10", "--max-iter", "5"])
    centers = [json.loads(line) for line in output(f"{out}/centers")]
    assert sum(c["size"] for c in centers) == 20 and all(len(c["center"]) == 10 for c in centers)
    assert -1 <= centers[0]["silhouette"] <= 1
    clusters = [json.loads(line) for line in output(f"{out}/clusters")]
    assert len(clusters) == 20 and {c["text"] for c in clusters} == {"good day, sun", "bad night moon"}
    assert len({(c["text"], c["predicted_cluster"]) for c in clusters}) == 2


def test_recommend_in_text_order(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    main(["recommend", lines("r", "2,1,1", "2,30,1", "2,4,1", "10,1,1"), out, "--sorted"])
    assert output(out) == ["10\t30,1.0", "10\t4,1.0"]
