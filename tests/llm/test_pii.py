import datetime as dt
import hashlib
import re

from pyspark.sql import functions as F

from cleanlane.llm import pii

KEY = "k"


def feistel(left, right, a, b, tag):
    for i in range(pii.ROUNDS):
        h = int(hashlib.sha256(f"{KEY}|{tag}|{i}|{right if i % 2 == 0 else left}".encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            left = (left + h % a) % a
        else:
            right = (right + h % b) % b
    return left, right


def luhn(s):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10


def run(frame, texts, **how):
    rows = frame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r["text"] for r in pii.pseudonymise(rows, KEY, **how).orderBy("doc_id").collect()]


def test_numbers_like_a_plain_network(frame):
    got = run(frame, ["227.5.221.1", "4539578763621486", "123-45-6789", "2024-02-29"])
    left, right = feistel(227 * 256 + 5, 221 * 256 + 1, 65536, 65536, "ipv4")
    assert got[0] == f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    left, right = feistel(5395787, 6362148, 10**7, 10**7, "card14")
    assert got[1][:15] == f"4{left:07d}{right:07d}" and luhn(got[1]) == 0
    left, right = feistel(122 * 99 + 44, 6788, 898 * 99, 9999, "ssn")
    area = left // 99
    assert got[2] == f"{area + 1 + (area >= 665):03d}-{left % 99 + 1:02d}-{right + 1:04d}"
    n = (dt.date(2024, 2, 29) - dt.date(1800, 1, 1)).days
    left, right = feistel(*divmod(n, pii.DAYS_B), pii.DAYS_A, pii.DAYS_B, "date")
    assert got[3] == str(dt.date(1800, 1, 1) + dt.timedelta(left * pii.DAYS_B + right))


def test_equal_values_stay_equal_in_their_format(frame):
    (got,) = run(frame, ["4539 5787 6362 1486; 4539-5787-6362-1486, 4539578763621486. on 29.02.2024 or 29/02/2024 (2024-02-29) +1 (017) 555-7713"])
    cards = re.findall(r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}", got)
    assert len(cards) == 3 and len({re.sub(r"\D", "", c) for c in cards}) == 1 and cards[0][4] == " " and cards[1][4] == "-"
    day = re.findall(r"(\d\d)([./])(\d\d)\2(\d{4})", got)
    iso = re.search(r"(\d{4})-(\d\d)-(\d\d)", got)
    assert {(d, m, y) for d, _, m, y in day} == {(iso[3], iso[2], iso[1])}
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}$", got) and "555-7713" not in got


def test_what_is_not_valid_stays(frame):
    texts = ["9807915762804491 x", "999.1.1.1 1.2.3.4.5", "000-12-1234 666-01-0001", "2023-02-29 31.04.2020", "token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\"", "v1.2.3.4", "plain text", "", None]
    assert run(frame, texts) == texts


def test_backwards_restores_everything(frame):
    texts = ["a 227.5.221.1. 4539578763621486! +49 30 1234567, (212) 555-0199", "x_y.34@mail7.example.com A.B+c@x.org ü.55@mail4.example.com", "123-45-6789 on 2024-02-29, 01/02/1999", None, "z" * 50000 + " 10.0.0.1"]
    rows = frame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, Values string")
    once = pii.pseudonymise(rows, KEY, count="n")
    back = pii.pseudonymise(once.drop("n"), KEY, backwards=True)
    assert [r["text"] for r in back.orderBy("doc_id").collect()] == texts
    assert [r["n"] for r in once.orderBy("doc_id").collect()] == [4, 3, 3, 0, 1]
    assert back.columns == rows.columns and pii.pseudonymise(rows.limit(0), KEY).count() == 0


def test_a_permutation_of_a_whole_domain(spark):
    pairs = spark.range(7 * 11).select(pii.permute(F.floor(F.col("id") / 11), F.col("id") % 11, 7, 11, KEY, F.lit("t")).alias("p"))
    assert sorted(tuple(r["p"]) for r in pairs.collect()) == [(x, y) for x in range(7) for y in range(11)]


def test_no_python_in_the_plan(frame):
    plan = pii.pseudonymise(frame([(1, "a")], "doc_id long, text string"), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_neighbours_do_not_hide_a_value(frame):
    phone, address, day, ssn, card, spaced = "+1 (826) 555-4081", "190.137.223.204", "2024-03-05", "123-45-6789", "4539578763621486", "4539 5787 6362 1486"
    alone = dict(zip((phone, address, day, ssn, card, spaced), run(frame, [phone, address, day, ssn, card, spaced])))
    assert all(k != v for k, v in alone.items())
    rows = [(phone, address), (phone, day), (phone, card), (phone, spaced), (phone, "2021"), (phone, ssn), ("+49 30 1234567", address), (card, "123"), (spaced, "123"), (spaced, "1226"), (card, "12/26"), (spaced, "12/26"), (card, day), (spaced, day), (card, address), (spaced, address), (spaced, ssn), ("12", card), ("12", spaced), ("1234", spaced), (day, spaced), (card, card), (spaced, spaced), (address, phone)]
    alone["+49 30 1234567"] = run(frame, ["+49 30 1234567"])[0]
    texts = [f"x {a} {b}." for a, b in rows]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.pseudonymise(docs, KEY, count="n").orderBy("doc_id").collect()
    assert [r["text"] for r in got] == [f"x {alone.get(a, a)} {alone.get(b, b)}." for a, b in rows]
    assert [r["n"] for r in got] == [(a in alone) + (b in alone) for a, b in rows]


def test_other_groupings_of_a_card_alone(frame):
    card = "4539578763621486"
    (want, *got) = run(frame, [card, "45395787 63621486", "453957-8763621486", "45395787 63621486 123456789", "45395787 63621486 4539 5787 6362 1486"])
    assert [re.sub(r"\D", "", g) for g in got] == [want, want, want + "123456789", want + want]


def test_a_long_run_of_groups(frame):
    (got,) = run(frame, ["12 " * 40000 + "4539-5787-6362-1486 " + "7" * 30000])
    assert got.startswith("12 12 ") and "4539-5787-6362-1486" not in got


def test_timestamps_and_month_first_dates(frame):
    days = [dt.date(2024, 3, 5), dt.date(2024, 12, 31), dt.date(1999, 1, 13), dt.date(2024, 2, 29), dt.date(1850, 6, 30), dt.date(2024, 12, 12)]
    texts = [f"{d} {d}T10:00:00Z {d:%d/%m/%Y} {d:%m/%d/%Y}" for d in days]
    got = run(frame, texts)
    for d, g in zip(days, got):
        iso, stamp, day_first, month_first = g.split(" ")
        new = dt.date.fromisoformat(iso)
        assert new != d and (new.day > 12) == (d.day > 12) and stamp == f"{new}T10:00:00Z" and day_first == f"{new:%d/%m/%Y}"
        assert d.day <= 12 or month_first == f"{new:%m/%d/%Y}"
    assert run(frame, got, backwards=True) == texts
    kept = ["2024-03-05Tx 2024-03-05a", "31/31/2024 02/30/2024 12.31.2024", "13/32/2024"]
    assert run(frame, kept) == kept


def test_dates_walk_to_different_dates(spark):
    days = spark.range(600).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    both = days.select("d", pii._day(F.col("d"), KEY, False).alias("p")).select("d", "p", pii._day(F.col("p"), KEY, True).alias("b")).collect()
    assert all(r["b"] == r["d"] and (r["p"].day > 12) == (r["d"].day > 12) for r in both) and len({r["p"] for r in both}) == 600


def test_domains_of_very_many_labels_end(frame):
    long = "x@" + "a." * 10**6 + "com"
    got = run(frame, [long, "write to jane.doe@mail.example.org now", "y@" + "ab." * 100 + "org"])
    assert got[0] == long and "jane.doe" not in got[1] and not got[2].startswith("y@")
