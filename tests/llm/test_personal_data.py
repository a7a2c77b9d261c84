from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterline.llm import pii
from tests.llm.conftest import odd_documents

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text: str | None) -> dict[str, list[tuple[int, int]]]:
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out[kind].append((m.start(), m.end()))
    return out


HARD = [
    "", None, "a@b.c_d@e.f.g x@y@z.com ..@a.b", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3",
    "4111 1111 1111 1111 a 4111-1111-1111-1111 b 41111111111111112 c 4111  1111 1111 1111", "+1 (212) 555-8457 +12345678 ++49 30 1234567-8-- +1 ( +1",
    "é😀 a@b.co 😀 10.0.0.1 ٣@x.y +49\xa030 12345678", "x" * 9000 + "@" + "y." * 4000 + "z " + "1" * 4000 + " " + "1." * 4000 + " +" + "1 " * 4000,
    "4111111111111111", "a.b@c.d.e-f.g-", "\\E a@b.c $1 \\",
]


def check(rows, texts):
    for r in rows:
        want = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k in PATTERNS for s, e in want[k])
        assert hashlib.sha256(joined.encode()).hexdigest() == r.base_sha256
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in PATTERNS]
        got = r.spans.split(",") if r.spans else []
        assert set(joined.split(",")) - {""} <= set(got)
        if not r.n_discovered:
            assert r.spans == joined


def test_base_spans(spark, documents, odd, none):
    hard = dict(enumerate(HARD))
    check(pii.personal_data(spark.createDataFrame(list(hard.items()), "doc_id bigint, text string")).collect(), hard)
    check(pii.personal_data(spark.createDataFrame([r[:2] for r in documents], "doc_id bigint, text string")).collect(), {r[0]: r[1] for r in documents})
    rows = pii.personal_data(odd).collect()
    assert len(rows) == len(odd_documents())
    check(rows, {r[0]: r[1] for r in odd_documents()})
    assert pii.personal_data(none).count() == 0


def test_contexts_discover_unseen_values(spark):
    rows = [(i, f"please write to me at user{i}@mail.example.com soon") for i in range(6)]
    rows += [(10, "please write to me at user[at]mail7 soon"), (11, "room 12345 is at level78 of it"), (12, "again user[at]mail7 elsewhere")]
    found = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    at = rows[6][1].index("user[at]")
    assert found[10].spans == f"email:{at}:{at + len('user[at]mail7')}"
    assert found[12].spans == "email:6:19"  # the value is known now, wherever it occurs
    assert found[11].spans == "" and found[0].n_discovered == 0


def test_signs_around_a_value_are_not_part_of_it(spark):
    rows = [(i, f"please write to me at user{i}@mail.example.com soon") for i in range(6)]
    rows += [(10, "please write to me at user[at]mail7 soon"), (12, "again (user[at]mail7), elsewhere or user[at]mail7.")]
    rows += [(13, "please write to me at x7@y, soon"), (14, "again x7@y elsewhere")]
    found = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[12].spans == "email:7:20,email:36:49"
    assert found[13].spans == "email:22:26" and found[14].spans == "email:6:10"


def test_masked_texts(spark, odd):
    rows = [(1, "a@b.co and 10.0.0.1 x", "k"), (2, None, None), (3, "+4111 1111 1111 1111 z", "k")]
    got = {r.doc_id: r.text for r in pii.masked(spark.createDataFrame(rows, "doc_id bigint, text string, kind string")).collect()}
    assert got[1] == "<EMAIL> and <IP> x" and got[2] is None
    assert "4111" not in got[3] and got[3].endswith(" z")
    masked = pii.masked(odd)
    assert masked.columns == odd.columns and masked.count() == len(odd_documents())


# --- a plain version of what contexts find ---------------------------------------------

SIGNS, BLANKS, KINDS = ".,;:!?\"'()[]{}<>", " \t\n\x0b\x0c\r", ["email", "ip", "card", "phone"]


def words_of(text):
    """Word, start and end of the words of a text, without the signs around them."""
    out = []
    for m in re.finditer(f"[^{BLANKS}]+", text):
        bare = m[0].strip(SIGNS)
        if bare:
            start = m.start() + len(m[0]) - len(m[0].lstrip(SIGNS))
            out.append((bare.lower(), start, start + len(bare)))
    return out


def plain_discovery(rows):
    seeds, filled = [], []
    for i, text in rows:
        every = sorted((s, e, k, text[s:e]) for k, spans in base(text).items() for s, e in spans)
        chars = list(text)
        for n, (s, e, k, v) in enumerate(every):
            before = every[n - 1][1] if n else 0
            after = every[n + 1][0] if n + 1 < len(every) else len(text)
            left = [w for w in (x.strip(BLANKS + SIGNS).lower() for x in re.split(f"[{BLANKS}]+", text[before : max(s, before)])) if w]
            right = [w for w in (x.strip(BLANKS + SIGNS).lower() for x in re.split(f"[{BLANKS}]+", text[e : max(after, e)])) if w]
            one, two, next_ = (left or [None])[-1], left[-2] if len(left) > 1 else None, (right or [None])[0]
            named = [("L", one, f"{two or ''} {next_ or ''}"), ("R", next_, one or "")]
            named += [("B", f"{one} {next_}" if one and next_ else None, ""), ("T", f"{two} {one}" if two else None, "")]
            seeds += [(f"{name} {w}", k, v, around) for name, w, around in named if w]
            chars[s:e] = "\ue000" * (e - s)
        filled.append((i, words_of("".join(chars))))
    count = Counter(w for _, words in filled for w, _, _ in words)
    trust, sizes = {}, {}
    for p in {x[0] for x in seeds}:
        own = [x for x in seeds if x[0] == p]
        per = {k: {x[2] for x in own if x[1] == k} for k in KINDS}
        ways = {k: {x[3] for x in own if x[1] == k} for k in KINDS}
        single, total = p[0] in "LR", sum(count.values())
        expected = total * (pii.FEW if p[0] == "B" else 1)
        for w in p[2:].split(" "):
            expected *= max(1, count[w]) / total
        if len(own) < pii.FLOOR * expected:
            continue
        for k in KINDS:
            if len(per[k]) >= pii.SUPPORT and (not single or len(ways[k]) >= pii.SUPPORT):
                trust[p, k], sizes[p, k] = len(per[k]), sum(len(v) for v in per.values())
    kept, edges = {p for p, _ in trust}, Counter()
    for _, words in filled:
        w = [x[0] for x in words]
        free = lambda j: 0 <= j < len(w) and "\ue000" not in w[j]
        number = lambda j: 0 <= j < len(w) and re.fullmatch("[0-9][0-9()/.+-]*", w[j])

        def run(j, step):
            n = 1
            while number(j) and n < pii.FEW and number(j + step * n):
                n += 1
            return n

        for j in range(len(w)):
            for p in (f"L {w[j]}", f"T {w[j - 1]} {w[j]}" if j else ""):
                if p in kept and free(j + 1):
                    edges[p, " ".join(w[j + 1 : j + 1 + run(j + 1, 1)])] += 1
            if f"R {w[j]}" in kept and free(j - 1):
                edges[f"R {w[j]}", " ".join(w[j - run(j - 1, -1) : j])] += 1
            for m in range(1, pii.FEW + 1):
                if j + m + 1 < len(w) and f"B {w[j]} {w[j + m + 1]}" in kept and all(free(j + 1 + q) for q in range(m)):
                    edges[f"B {w[j]} {w[j + m + 1]}", " ".join(w[j + 1 : j + 1 + m])] += 1
    unknown = Counter(p for p, _ in edges)
    weight = {pk: sizes[pk] + pii.ALPHA * unknown[pk[0]] for pk in trust if unknown[pk[0]]}
    now = {pk: min(0.99, trust[pk] / weight[pk]) for pk in weight}
    for turn in range(pii.ROUNDS):
        score = {}
        for p, v in edges:
            for k in KINDS:
                if (p, k) in now:
                    score[v, k] = score.get((v, k), 0.0) + math.log(1 - now[p, k])
        if turn == pii.ROUNDS - 1:
            break
        more = dict.fromkeys(now, 0.0)
        for p, v in edges:
            for k in KINDS:
                if (p, k) in now:
                    more[p, k] += 1 - math.exp(score[v, k] - math.log(1 - now[p, k]))
        now = {pk: min(0.99, (trust[pk] + pii.ALPHA * more[pk]) / weight[pk]) for pk in now}
    best = {}
    for (v, k), miss in score.items():
        if 1 - math.exp(miss) >= pii.ACCEPT:
            best[v] = max(best.get(v, (0, "")), (1 - math.exp(miss), k))
    inside = {v: max(n for (_, x), n in edges.items() if x == v) for v in best}
    hits = []
    for i, words in filled:
        for j in range(len(words)):
            for m in range(1, pii.FEW + 1):
                v = " ".join(x[0] for x in words[j : j + m])
                if j + m <= len(words) and v in best:
                    hits.append((v, i, words[j][1], words[j + m - 1][2]))
    often = Counter(h[0] for h in hits)
    found = {}
    for v, i, s, e in hits:
        if often[v] <= pii.COMMON * inside[v]:
            found.setdefault(i, set()).add((s, -e, best[v][1]))
    out = {}
    for i, spans in found.items():
        upto = 0
        for s, minus, k in sorted(spans):
            if -minus > upto:
                out.setdefault(i, []).append((k, s, -minus))
            upto = max(upto, -minus)
    return out


def random_rows(seed, n=260):
    rng = random.Random(seed)
    fill = [f"w{i}" for i in range(60)]
    some = lambda k: " ".join(rng.choice(fill) for _ in range(rng.randrange(1, k)))
    made = {
        "email": lambda: f"u{rng.randrange(500)}@mail{rng.randrange(9)}.example.com", "phone": lambda: f"+44 20 7946 0{rng.randrange(100, 1000)}",
        "ip": lambda: f"10.{rng.randrange(256)}.1.{rng.randrange(256)}", "card": lambda: "4111 1111 1111 1111",
        "odd": lambda: rng.choice(["john at mail dot com", "020 7946 0958", "JohnSmith", "user[at]mail", "(020) 555-2485", "x", "w1 w2"]),
    }
    cues = ["Tel:", "mail me at", "host <", "Contact (", "call"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            cue = rng.choice(cues)
            kind = rng.choice(["phone", "phone", "odd"] if cue in ("Tel:", "call") else ["email", "email", "odd"] if cue == "mail me at" else list(made))
            parts.append(f"{some(5)} {cue} {made[kind]()}{rng.choice(['', '.', ', ', ')'])} {rng.choice(['soon', 'or', some(3)])}")
        rows.append((i, rng.choice([" ", "\n", "  "]).join([*parts, some(6)])))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_discovery_equals_the_plain_version(spark, seed):
    rows = random_rows(seed)
    want = plain_discovery(rows)
    got = pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(want) > 5
    for r in got:
        own = base(rows[r.doc_id][1])
        both = [(k, s, e) for k in KINDS for s, e in sorted(own[k] + [(s, e) for kind, s, e in want.get(r.doc_id, []) if kind == k])]
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in both), rows[r.doc_id]
        assert r.n_discovered == len(want.get(r.doc_id, []))


def test_many_patterns_take_several_passes(spark, monkeypatch):
    rows = random_rows(1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    once = sorted(map(str, pii.personal_data(docs).collect()))
    monkeypatch.setattr(pii, "AT_ONCE", 2)
    assert sorted(map(str, pii.personal_data(docs).collect())) == once


def test_words_after_a_cue_between_varying_words(spark):
    """One word is a pattern if it stands in different surroundings; a run of numbers and undigitised names are whole spans."""
    rows = [(i, f"a{i} b{i} Tel: +44 20 7946 09{i:02d} c{i} d{i}") for i in range(8)]
    rows += [(20, "some tel: 020 7946 0958 later"), (21, "elsewhere 020 7946 0958, again"), (22, "other (tel) johnsmith now")]
    rows += [(30 + i, f"mail me at user{i}@mail.example.com today") for i in range(6)] + [(40, "mail me at john at mail dot com today"), (41, "so John at mail dot com it is")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert found[20] == "phone:10:23" and found[21] == "phone:10:23" and found[22] == "phone:12:21"
    assert found[40] == "email:11:31" and found[41] == "email:3:23"
    texts = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert texts[20] == "some tel: <PHONE> later" and texts[21] == "elsewhere <PHONE>, again" and texts[22] == "other (tel) <PHONE> now"
    assert texts[40] == "mail me at <EMAIL> today" and texts[41] == "so <EMAIL> it is" and texts[0] == "a0 b0 Tel: <PHONE> c0 d0"


def test_ordinary_words_are_left_alone(spark):
    """A word that stands elsewhere much more often than in the slot, and a cue that is everywhere."""
    rows = [(i, f"mail me at user{i}@mail.example.com today") for i in range(6)] + [(10, "mail me at home today")]
    rows += [(20 + i, f"x{i} home y{i}") for i in range(12)]
    rows += [(50 + i, f"p{i} the +44 20 7946 09{i:02d} q{i}") for i in range(4)] + [(100 + i, f"the z{i} on the v{i}") for i in range(200)]
    got = pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got.where("n_discovered > 0").count() == 0


def test_empty_tables_and_clashing_columns(spark, none, odd):
    assert pii.masked(none).count() == 0 and pii.masked(none).columns == none.columns
    rows = spark.createDataFrame([("mail me at a@b.co", 1, "k", [1])], "text string, doc_id bigint, words string, every array<int>")
    assert tuple(pii.masked(rows).first()) == ("mail me at <EMAIL>", 1, "k", [1])


def test_texts_are_read_once_and_once_more_for_places(spark):
    rows = random_rows(1)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        read.add(1)
        return text

    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("text", told.asNondeterministic()("text"))
    assert any(r.n_discovered for r in pii.personal_data(docs).collect())
    assert read.value <= 2 * len(rows)


def test_places_of_common_values_are_counted_not_kept(spark, monkeypatch):
    rows = [(i, f"mail me at user{i}@mail.example.com today") for i in range(6)] + [(10, "mail me at home today"), (11, "mail me at sweet home today")]
    rows += [(100 + i, f"x{i} " + "home sweet home " * 30) for i in range(60)]
    kept, cut = [], pii.cut
    monkeypatch.setattr(pii, "cut", lambda rows, label="cut": kept.append(cut(rows, label)) or kept[-1])
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).where("n_discovered > 0").collect()
    assert not found and max(k.count() for k in kept) <= 2 * len(rows)


def test_any_word_of_a_pattern_or_value_meets_its_places(spark):
    """Also where words are there twice, in different patterns, or at the ends of a text."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["a", "b", "a", "c", "5", ""]) for _ in range(rng.randrange(0, 12)))) for i in range(80)]
    found = pii.found_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).cache()
    names = ["L a", "L 5", "R b", "R 5", "T a b", "T b a", "T a a", "T 5 5", "B a b", "B b a", "B a a", "B c 5"]
    by_off, kinds = [], [(0, 0), (0, 1), (1, 0), (1, 1)]
    for t, b in kinds:
        offs = {"T": t, "B": b}
        patterns = spark.createDataFrame([(p, offs.get(p[0], 0)) for p in names], "pattern string, off int")
        by_off.append(sorted(map(tuple, pii.slots(found, patterns).collect())))
    assert by_off[0] and all(x == by_off[0] for x in by_off)
    texts = ["a", "a b", "b a", "a a", "a b a", "5 a 5 a", "c c c c c"]
    plain = sorted((i, v, at, v.count(" ") + 1) for i, text in rows for v in texts for at in range(len(text.split())) if text.split()[at : at + v.count(" ") + 1] == v.split())
    for pick in (lambda n: 0, lambda n: n - 1, lambda n: n // 2):
        values = spark.createDataFrame([(v, pick(v.count(" ") + 1)) for v in texts], "value string, off int")
        assert sorted(tuple(r) for r in pii.places(found, values).select("doc_id", "value", "i", "m").collect()) == plain


def test_masking_reads_texts_three_times(spark):
    """For the spans and words, for places of what was found, and to be masked."""
    rows = random_rows(1)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        read.add(1)
        return text

    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("text", told.asNondeterministic()("text"))
    assert len(pii.masked(docs).collect()) == len(rows)
    assert read.value <= 3 * len(rows)
