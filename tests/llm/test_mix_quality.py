import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import mix, quality

PROSE = {
    "en": "The guard at the gate had seen that the truck was not on the list, so he asked the driver for a paper and wrote it down in the book before they went on.",
    "ro": "Camera de la poartă a notat că numărul nu este pe listă, iar șoferul a fost rugat să aștepte până când se face un raport după tură.",
    "de": "Die Kamera an der Schranke hat das Kennzeichen nicht erkannt, aber der Fahrer ist mit dem Wagen auf den Hof gefahren und wartet nun vor dem Tor.",
}


def test_pivot_keeps_the_tokens():
    r = random.Random(3)
    for n in (0, 1, 2, 7, 400):
        mass, part = np.array([r.randint(1, 900) for _ in range(n)], dtype=np.int64), np.array([r.choice([0.0, 1.0, 0.3, 0.3, 0.8]) for _ in range(n)])
        out = mix.pivot(np.arange(n), mass, part, 1, 0)
        assert sum(p not in (0.0, 1.0) for p in out) <= 1
        assert (mass * out).sum() == pytest.approx((mass * part).sum(), abs=1e-3)
    kept = np.mean([mix.pivot(np.array([4, 9]), np.array([10, 10]), np.array([0.3, 0.3]), seed, 0) for seed in range(2000)], axis=0)
    assert kept == pytest.approx([0.3, 0.3], abs=0.03)
    uneven = np.mean([mix.pivot(np.arange(5), np.array([5, 10, 30, 7, 1]), np.array([0.3, 0.6, 0.2, 0.9, 0.5]), seed, 0) for seed in range(3000)], axis=0)
    assert uneven == pytest.approx([0.3, 0.6, 0.2, 0.9, 0.5], abs=0.04)


def test_mixture(spark):
    r = random.Random(5)
    sources = ["web_crawl"] * 6 + ["Web Crawl ", "notes", "NOTES", "other", None]
    docs = [(i, " ".join(["word"] * r.randint(1, 60)), r.choice(sources)) for i in range(2500)] + [(9001, None, "notes"), (9002, "", "notes")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"tokens": F.lit("clash"), "copies": F.lit("clash"), "leaf": F.lit(1)})
    targets = spark.createDataFrame([("web_crawl", 0.3, 1), ("notes", 0.5, 2), ("absent", 0.2, 3)], "source string, target_weight double, max_repeats int")
    mixture, plan = mix.mix(df, targets, leaf_rows=100, fan=4)
    rows = mixture.collect()
    lines = {p["source"]: p for p in plan.collect()}
    total = sum(p["tokens"] for p in lines.values())
    assert max(x["copies"] for x in rows if x["source"] == "notes") <= 2 and len({x["doc_id"] for x in rows}) == len(rows)
    for name, line in lines.items():
        assert abs(sum(x["tokens"] * x["copies"] for x in rows if x["source"] == name) - line["planned"]) <= 61
    web, notes = lines["web_crawl"], lines["notes"]
    assert web["planned"] + notes["planned"] == pytest.approx(min(total, web["tokens"] + 2 * notes["tokens"])) and notes["planned"] == 2 * notes["tokens"]
    assert {s for s, p in lines.items() if p["falls_short"]} == {s for s, p in lines.items() if p["tokens"] * p["max_repeats"] < p["wanted"]}
    assert "absent" in {s for s, p in lines.items() if p["falls_short"]}
    again, _ = mix.mix(df.repartition(7), targets, leaf_rows=100, fan=4)
    assert {tuple(x) for x in again.collect()} == {tuple(x) for x in rows}
    report = {x["source"]: x for x in mix.mix_report(mixture, plan).collect()}
    assert report["absent"]["mixed_tokens"] == 0 and sum(x["actual_share"] for x in report.values()) == pytest.approx(1, abs=1e-5)
    none, empty = mix.mix(df.where("false"), targets)
    assert none.count() == 0 and empty.count() == 3


def test_tokens(spark):
    df = spark.createDataFrame([(1, "The plate was clean."), (2, None), (3, ""), (4, "x" * 200_000)], "doc_id int, text string")
    got = {r["doc_id"]: r["tokens"] for r in mix.with_tokens(df).collect()}
    assert got[1] == 5 and got[2] == got[3] == 0 and got[4] > 1000


def test_prose_shares():
    words = frozenset("the of and to in a is that was for it with as on be at by this had not so he before they went de la și a că nu este pe iar fost până când se după die der und das nicht aber ist mit dem auf den vor an".split())
    common = quality._Common(words)
    for text in PROSE.values():
        assert quality.prose_shares(text, common)[1] > 0.8
        assert quality.prose_shares(text.upper().replace(" ", "\n   ", 7), common)[1] > 0.5
        wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in text)
        assert quality.prose_shares(wide, common)[1] > 0.8
    for text in ("key: 1\nspeed: true\nplate -> AB 12 CDE", "- queue of the shutter\n- plate\n- list of the night run", "%%% ### ((( ***", "lorry gate lorry gate camera lorry", "1. die Liste\n2. das Tor\n3. die Kamera an der Schranke", None, " \n"):
        assert quality.prose_shares(text, common)[1] < 0.2


def test_short_sentences_run_and_list_items_do_not():
    common = quality._Common(frozenset("the a another of and was that she by had one this my out in".split()))
    prose = "# Handover 303\n\nDuring the audit, the contact sheet measured every character.\n\nAnother rain-streaked windscreen fell below its limit.\n\nShe was told that one loading dock had counted my sequence."
    assert quality.prose_shares(prose, common)[1] > 0.5
    assert quality.prose_shares("The frozen checkpoint rejected one trailer.\nThe last batch drifted out of view!", common)[1] > 0.9
    for text in (
        "• score curve of the false alarm.\n• manifest of the night run operator.\n• tablet.", "13 x character.\nWL38DBA.\ndigit group of the folder.\nLN04HFP.\ntow bar of the street.",
        "dirt patch crop mounting screw " * 30 + "the end.", "9f550da45981b3fb.jpg 8bf1165661290ada 65bc65eb3d688ebc " * 6 + "the reading of the day was late.", "1. contact sheet of the first test bench.\n2. tow bar of the old cable duct.",
    ):
        assert quality.prose_shares(text, common)[1] < 1 / 3


def test_scores_and_decision(spark):
    r = random.Random(4)
    junk = ["a1 -> 7\nb2 -> 9\nc3 -> none", "%% ## !! ??", "- plate\n- gate\n- list of the day", None, "  ", "lorry gate " * 40]
    docs = [(i, PROSE[l] + " " + r.choice(list(PROSE.values())), r.choice([l, l.upper(), f"{l}-XX", None])) for i, l in enumerate(r.choices(list(PROSE), k=120))]
    docs += [(1000 + i, r.choice(junk), r.choice(["en", "de", "zz!", None])) for i in range(40)]
    words = spark.createDataFrame([("en", w, 1) for w in "the of and to in a is that was for it with as on be at by this had not so he before they went".split()] + [("ro", w, 1) for w in "de la și a că nu este pe iar fost până când se după".split()] + [("de", w, 1) for w in "die der und das nicht aber ist mit dem auf den vor an hat nun".split()] + [("xx", None, 1)], "lang string, word string, rank int")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"score": F.lit("clash"), "words": F.lit(0), "n": F.lit(0)})
    stats = quality.text_statistics(df, words)
    scored = quality.tail_scores(stats)
    rows = {x["doc_id"]: x for x in scored.collect()}
    assert len(rows) == 160
    assert {x["doc_id"] for x in quality.not_prose(scored).collect()} == {d for d, _, _ in docs if d >= 1000}
    names = list(quality.STATISTICS)
    for lang in {x["lang_key"] for x in rows.values()}:  # brute-force tails
        own = [x for x in rows.values() if x["lang_key"] == lang]
        for x in own[:10]:
            import math

            total = 0.0
            for c in names:
                low, high = sum(y[c] <= x[c] for y in own) / len(own), sum(y[c] >= x[c] for y in own) / len(own)
                total -= math.log({"low": low, "high": high, "both": min(1, 2 * min(low, high))}[quality.STATISTICS[c]])
            assert x["score"] == pytest.approx(total, abs=1e-6)
    shuffled = quality.tail_scores(stats, most_broadcast=0)
    assert {x["doc_id"]: round(x["score"], 9) for x in shuffled.collect()} == {k: round(x["score"], 9) for k, x in rows.items()}
    twice = quality.tail_scores(stats.union(stats))
    assert twice.count() == 320
    assert quality.tail_scores(quality.text_statistics(df.where("false"), words)).count() == 0


def test_score_places_the_cut_between_the_bounds(spark):
    """Documents of one share between the bounds: the outliers are not prose. Without the score the rows change."""
    cols = "doc_id long, lang_key string, words long, mean_word_length double, symbol_ratio double, ended_lines double, common_share double, sentence_share double"
    rows = [(i, "en", 100 + i % 9, 4.5 + i % 5 / 10, 0.02, 1.0, 0.4, 0.9) for i in range(60)]
    rows += [(100 + i, "en", 5 + i, 9.0, 0.4, 0.1, 0.0, 0.1) for i in range(20)]
    rows += [(200, "en", 104, 4.7, 0.02, 1.0, 0.4, 0.44), (201, "en", 4, 9.5, 0.5, 0.0, 0.0, 0.44), (202, "en", 4, 9.5, 0.5, 0.0, 0.0, 0.51), (203, "en", 104, 4.7, 0.02, 1.0, 0.4, 0.33), (300, "xx", 4, 9.5, 0.5, 0.0, 0.0, 0.45)]
    scored = quality.tail_scores(spark.createDataFrame(rows, cols))
    found = {x["doc_id"] for x in quality.not_prose(scored).collect()}
    assert found == {*range(100, 120), 201, 203}
    flat = {x["doc_id"] for x in quality.not_prose(scored.withColumn("score", F.lit(0.0))).collect()}
    assert flat == {*range(100, 120), 203}
    nulls = quality.tail_scores(spark.createDataFrame([(1, None, None, None, None, None, None, None)], cols))
    assert [(x["doc_id"], x["lang_key"], x["score"]) for x in nulls.collect()] == [(1, "und", 0.0)]
    assert [x["doc_id"] for x in quality.not_prose(nulls).collect()] == [1]
    assert quality.not_prose(scored.where("false")).count() == 0


def test_lists_by_semicolons_and_prose_in_the_dress_of_a_list():
    common = quality._Common(frozenset("the a of and was that in at by had this not so he before they went an on only whenever die der das hinter dem an mit aus auf".split()))
    entries = "das Lager hinter dem Tor x1; die doppelte Aufnahme; die Kamera an der Schranke x2; das Licht der Scheinwerfer; das Fahrzeug auf der Waage; " * 4
    assert quality.prose_shares(entries, common)[1] < 0.2
    clauses = "The guard at the gate had seen that the truck was not on the list; he asked the driver for a paper and wrote it down in the book before they went on."
    assert quality.prose_shares(clauses, common)[1] > 0.8
    dressed = "- The ordinary label file doubled the\n- street sign, whenever an overexposed\n- driver on a muddy road turned at the\n- mounting screw. As soon as that was\n- known, he asked the guard in the\n- yard for a paper and went on."
    assert quality.prose_shares(dressed, common)[1] > 0.8
    assert quality.prose_shares(dressed.replace("- ", "> "), common)[1] > 0.8
    items = "- label file of the review note\n- queue of the shutter\n- plate\n- list of the night run\n- crop of the source folder\n- hyphen"
    assert quality.prose_shares(items, common)[1] < 0.2
