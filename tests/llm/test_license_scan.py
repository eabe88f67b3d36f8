import random
import re

from tests.llm.corpus import frame, texts
from tidemark.llm.license_scan import BASE_PHRASES, NOTICES, Scanner, license_scan, pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    found = WORD.findall((text or "").translate(UPPER))
    places = []
    for phrase, label in BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(found)) if found[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_agrees_with_brute_force(spark):
    rows = [
        *texts(4), "Released under the MIT License.", "under-the/mit_license under the mit license", "Apache License, Version 2.0", "CC BY-NC 4.0 cc by nc",
        "cc by ncs", "aunder the mit license", "UNDER THE MIT LICENSE" * 3, "under the mit licenseé",
    ]
    got = license_scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(rows[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_edits_are_found_up_to_the_bound():
    scanner = Scanner()
    for text, label in [
        ("Released udner the MIT licence today", None), ("under the MIT licens", "mit"), ("under the m1t license", "mit"),
        ("GNU Generel Public License", "gpl"), ("all right reserved", "all-rights-reserved"), ("all the rights we reserved", None),
    ]:
        got = scanner.scan(text)["labels"]
        assert (label in got.split(",")) if label else got == "", text
    span = scanner.scan("a b c under the mit licens d")["spans"][0]
    assert (span["start"], span["end"], span["edits"]) == (3, 7, 1)


def test_adjacent_notices_are_all_found():
    scanner = Scanner()
    good, bad = "all rights reserved", "all rights reservd"
    for text, want in [
        (" ".join([bad] * 10 + [good]), [1] * 10 + [0]), (" ".join([bad] * 10), [1] * 10), (f"{bad} x y {good}", [1, 0]),
        (f"{good} {bad} {good}", [0, 1, 0]), (f"{bad} {good} {bad}", [1, 0, 1]),
    ]:
        assert [s["edits"] for s in scanner.scan(text)["spans"]] == want, text


def test_adjacent_notices_agree_with_edit_distance():
    rnd = random.Random(3)
    scanner = Scanner()
    for _ in range(300):
        notice = rnd.choice([n for n, (_, e) in NOTICES.items() if e])
        label, most = NOTICES[notice]
        planted, before = [], []
        for _ in range(rnd.randint(2, 7)):
            own = notice
            for _ in range(rnd.randint(0, most)):
                # the first and last letters stay, so that a place is no shorter than its words
                at = rnd.choice([i for i in range(1, len(own) - 1) if " " not in own[i - 1 : i + 2]])
                own = own[:at] + rnd.choice(("", "q", own[at] + "q")) + own[at + 1 :]
            before.append(sum(len(x.split()) for x in planted))
            planted.append(own)
        spans = [s for s in scanner.scan(" ".join(planted))["spans"] if s["label"] == label]
        want = [(a, a + len(x.split()), distance(x, notice)) for a, x in zip(before, planted)]
        assert [(s["start"], s["end"], s["edits"]) for s in spans] == want, planted


def test_pieces_cover_a_notice_and_one_survives():
    for notice, (_, edits) in NOTICES.items():
        parts = pieces(notice, edits)
        assert b"".join(p for _, p in parts) == notice.encode() and len(parts) == edits + 1
    assert distance("license", "licence") == 1


def test_empty_table(spark):
    assert license_scan(frame(spark, [])).count() == 0
