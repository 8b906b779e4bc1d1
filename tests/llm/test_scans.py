"""License scan, decontamination and quality rules against brute force and planted cases."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, license_scan, quality_rules, text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_base(t):
    w, at, labels = WORD.findall(lowered(t)), [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        hit = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        at += hit
        labels |= {label} if hit else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


LICENSED = [
    (201, "The MIT License. the mit-license (MIT)\nlicense; mit license mit license"),
    (202, "x General Public\tLicense y general public licenses general public general public license"),
    (203, "ＭIT License, Apache License, Version 2.0 apache license"),
    (204, "mit \u212aicense and mit license\u0130 MİT License"),
    (205, "Permission is hereby granted, free of charge, to any person obtaining just a copy of this software and associated documentation files"),
    (206, "You can redistribute it and/or modify it under the terms"),
    (207, "Licensed under CC BY-NC 4.0. " * 3),
    (None, "Released under the MIT License."),
    (209, "Released under the MIT License."), (209, "Released under the MIT License."),
]


def test_base_places(frame, hard):
    rows = hard + LICENSED
    got = license_scan.label_documents(frame(rows).repartition(4)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter(tuple(r) for r in got.collect()) == Counter((k, *brute_base(t)) for k, t in rows)


def test_notices_with_changes_are_found(frame):
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.label_documents(frame(LICENSED)).collect()}
    assert got[205][0] == "mit" and 0.8 <= got[205][1] < 1  # one word was put in: two diagonals merge
    assert got[206] == ("", 0.0)  # the head of a notice alone
    assert got[207] == ("cc-by-nc", 1.0)
    assert got[None] == got[209] == ("mit", 1.0)


def test_one_changed_or_added_word_never_hides_a_notice(frame):
    """At every place of every notice."""
    rows, want = [], {}
    for phrase, label in license_scan.NOTICES.items():
        w = phrase.split()
        for i in range(len(w)):
            for text in ([*w[:i], "zzz", *w[i + 1 :]], [*w[:i], "zzz", *w[i:]]):
                want[len(rows)] = label
                rows.append((len(rows), "so it is " + " ".join(text) + " then"))
    got = {r.doc_id: r.labels.split(",") for r in license_scan.label_documents(frame(rows)).collect()}
    assert [rows[k] for k, label in want.items() if label not in got[k]] == []


def filters(df):
    """Conditions of the filters of the optimised plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Filter" in line]


def test_plans_compute_runs_once(docs, bench):
    """No filter splits or hashes whole texts once more below the lines of their runs."""
    frames = [license_scan.label_documents(docs), decontaminate.find(docs, bench), decontaminate.clean(docs, bench)]
    assert [x for f in frames for x in filters(f) if re.search(r"split\(|lower\(", x)] == []


def test_very_long_texts(frame):
    """20,000 words, with a notice and an item at the end."""
    body = " ".join(f"wort{i % 977}" for i in range(20_000))
    rows = [(1, f"{body} Released under the MIT License. {ITEM}"), (2, body)]
    items = frame(rows[:1]).sparkSession.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert [(r.doc_id, r.first_word) for r in decontaminate.find(frame(rows), items).collect()] == [(1, 20_005)]
    got = {r.doc_id: (r.n_words, r.n_base, r.labels) for r in license_scan.label_documents(frame(rows)).collect()}
    assert got == {1: (brute_base(rows[0][1])[0], 1, "mit"), 2: (20_000, 0, "")}


def test_scan_limits(empty, docs):
    assert license_scan.label_documents(empty).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(docs, phrases={"mit": "mit"})


ITEM = "A train from Paris travels 120 km in 2 hours before it stops, then Anna walks 3 km home and thinks about 120 small things on the way"
BENCH = [(1, ITEM), (2, None), (3, ""), (4, "short question about seven stones"), (None, "the quick brown fox jumps over the lazy dog again and again today"), (6, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (7, "Nobody knew how many green bottles were hanging there on the wall")]


@pytest.fixture(scope="session")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string").withColumn("doc", F.lit("x"))


def pairs(df):
    return {(r.doc_id, r.item_id): r for r in df.collect()}


def test_items_are_found_with_other_numbers_and_names(frame, bench, hard):
    changed = ITEM.replace("120", "350").replace("Paris", "Lyon").replace("3 km", "9 km")
    uneven = ITEM.replace("travels 120", "travels 350")  # 120 stands for 350 and for 120
    rows = [
        (301, "before it " + ITEM + " after"), (302, "intro. " + changed), (303, uneven), (304, ITEM.upper().replace(",", ";")),
        (305, "someone asked: Short question about 7 stones!"), (306, "The quick brown fox jumps over the lazy dog again and again today"),
        (307, "the quick brown fox jumps over the lazy dog"), (308, "11 12 13 14 15 16 17 18 19 20 21 22 23 24 25"), (None, ITEM), (310, ITEM), (310, ITEM),
        (311, "as we said: nobody asked, yet Nobody knew how many green bottles were hanging there on the wall"),
    ]
    got = pairs(decontaminate.find(frame(rows + hard), bench))
    assert set(got) == {(301, 1), (302, 1), (305, 4), (306, None), (None, 1), (310, 1), (311, 7)} | ({(304, 1)} & set(got))
    assert got[302, 1].slots_changed and not got[301, 1].slots_changed
    assert got[301, 1].first_word == 2
    assert got[305, 4].n_windows == 1
    kept = decontaminate.clean(frame(rows + hard), bench)
    assert kept.columns == frame(hard).columns
    gone = {k for k, _ in got}
    assert kept.count() == sum(k not in gone for k, _ in rows + hard)


def test_shuffle_join_gives_the_same(frame, bench):
    rows = [(301, "before it " + ITEM + " after"), (302, "nothing here at all")]
    one, two = (pairs(decontaminate.find(frame(rows), bench, most_broadcast=n)) for n in (10, 2_000_000))
    assert one == two and set(one) == {(301, 1)}


def test_without_items_or_documents(frame, bench, empty, hard):
    assert decontaminate.find(empty, bench).count() == 0
    assert decontaminate.find(frame(hard), bench.limit(0)).count() == 0
    assert decontaminate.clean(frame(hard), bench.limit(0)).count() == len(hard)


DENSE = [
    (20, "A shop sells 3 pens for 12 dollars and 5 books for 40 dollars each"), (21, "What is 12 + 45 - 7 * 3 equal to in total?"),
    (22, "Then Anna gave Ben 3 apples and Carla gave David 5 pears"), (23, "3 1 4 1 5 9 2 6 5 3 5 8 9 7"),
]
NAMED = "Yesterday in town Anna met Ben and Carla while David told Erik about Frida who saw Gustav near the old stone bridge"


def test_items_dense_in_values_are_found(spark, frame):
    bench = spark.createDataFrame(DENSE, "item_id long, text string")
    rows = [(i, "so: " + t + " and on") for i, t in DENSE] + [
        (30, "A shop sells 7 pens for 19 dollars and 6 books for 80 dollars each"), (32, "Then Ida gave Tom 8 apples and Rosa gave Karl 9 pears"),
        (33, "2 7 1 8 2 8 1 8 2 8 4 5 9 0"), (34, "A shop sells 7 pens for 19 dollars"),
    ]
    got = pairs(decontaminate.find(frame(rows), bench))
    assert set(got) == {(20, 20), (21, 21), (22, 22), (23, 23), (30, 20), (32, 22)}


def test_copies_in_other_case_and_with_spelled_numbers_are_found(spark, frame):
    spelled = "The farmer sold twelve brown cows and bought eight young goats at the autumn market"
    bench = spark.createDataFrame([(1, NAMED), (2, spelled)], "item_id long, text string")
    rows = [(1, NAMED.lower()), (2, NAMED.upper()), (3, NAMED.title()), (4, spelled.replace("twelve", "twenty").replace("eight", "fifteen")), (5, spelled.replace("twelve", "twenty-one"))]
    assert set(pairs(decontaminate.find(frame(rows), bench))) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2)}


def test_one_altered_value_does_not_clear_a_long_item(frame, bench):
    rows = [(1, ITEM.replace("travels 120", "travels 350")), (2, ITEM[: ITEM.index(" before")].replace("120", "350"))]
    assert set(pairs(decontaminate.find(frame(rows), bench, by_stretch=True))) == {(1, 1)}


def test_texts_of_one_key_are_judged_apart(frame, bench):
    half = ITEM.split()
    rows = [(1, ITEM), (1, "a clean text"), (2, " ".join(half[:10])), (2, "x " * 7 + " ".join(half[7:17])), (3, ITEM), (3, ITEM.replace("120", "350"))]
    assert set(pairs(decontaminate.find(frame(rows), bench))) == {(1, 1), (3, 1)}
    assert sorted((r.doc_id, r.text) for r in decontaminate.clean(frame(rows), bench).collect()) == sorted([rows[1], rows[2], rows[3]])


def brute_statistics(t):
    t = t or ""
    w = [x for x in SPACE.split(t) if x]
    lines = [x for x in t.split("\n") if SPACE.sub("", x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)


REPEATS = [
    (401, "a b c d e f g h a b c d e f g h i"), (402, "x " * 9), (403, "one\ntwo\none\n\n \none\ntwo x\u000b\ntwo"), (404, "#|*$%&<> 漢字 \U0001f600é"),
    (405, " ".join(f"w{i % 50}" for i in range(4000))), (406, "p q r s t u v w " * 2 + "z " + "q r s t u v w p " * 2),
]


def test_statistics(frame, hard):
    rows = hard + REPEATS
    got = quality_rules.statistics(frame(rows).repartition(3)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(tuple(r) for r in got.collect()) == Counter((k, *brute_statistics(t)) for k, t in rows)


def test_rules_are_learned_and_ordered(spark):
    rows = spark.range(6000).selectExpr(
        "id", "rand(1) * 100 a", "rand(2) * 100 b", "rand(3) c").selectExpr("*", "cast((a > 70 and b <= 40) or c > 0.9 as int) bad")
    found = quality_rules.learn(rows, features=("a", "b", "c"), cuts=40)
    assert 2 <= len(found.rules) <= 4
    judged = rows.withColumn("no", found.rule_index().isNotNull().cast("int"))
    assert judged.where("no <> bad").count() < 6000 * 0.03
    first = found.rules[0]
    assert all(c.feature in "abc" for c in first) and "reject if" in str(found)


def test_rare_defects_and_rules_behind_a_failed_one_are_learned(spark):
    """1 % of the rows have a low b; 5 % are bad without a cause, which a rule on a follows but can't reach the precision."""
    rows = spark.range(6000).selectExpr("id", "rand(4) r", "rand(5) u").selectExpr(
        "id", "r < 0.01 rare", "if(r < 0.01, 0.1 + u / 5, 0.5 + u / 2) b", "rand(6) a").selectExpr("*", "cast(rare or (a > 0.9 and rand(7) < 0.5) as int) bad")
    found = quality_rules.learn(rows, features=("a", "b"))
    judged = rows.withColumn("no", found.rule_index().isNotNull())
    assert judged.where("rare and not no").count() <= 1
    assert judged.where("no and bad = 0").count() <= 6


def test_one_class_or_nothing_keeps_all(spark):
    rows = spark.range(50).selectExpr("cast(id as double) a", "0 bad")
    for frame_ in (rows, rows.withColumn("bad", F.lit(1)).limit(0), rows.withColumn("bad", F.lit(None).cast("int"))):
        assert quality_rules.learn(frame_, features=("a",)).rules == []


def test_judge_keeps_every_row(spark, docs, hard, empty):
    labels = spark.createDataFrame([(k, 1, 0) for k, _ in hard if k] + [(None, 0, 0), (1, None, 1)], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in hard)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule is None)
    assert quality_rules.judge(empty, labels).count() == 0


def test_words_and_grams(spark):
    row = spark.createDataFrame([(" a\x0b b\u00a0c ",), (None,), ("",)], "t string").select(text.words(F.col("t")).alias("w"), F.size(text.grams(text.words(F.col("t")), 2)).alias("n")).collect()
    assert [(r.w, r.n) for r in row] == [(["a", "b\u00a0c"], 1), ([], 0), ([], 0)]
