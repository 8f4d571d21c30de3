from pyspark.sql import functions as F

from odflow.llm import pii

TEXTS = [
    "mail und.34@mail7.example.com und A.B@X.DE.", "ip 233.254.104.120, 1.2.3.4. v 999.1.1.1 1.2.3.4.5",
    "card 4111111111111111 4111 1111 1111 1111 4111111111111112 378282246310005 3782-822463-10005 0000000000000000",
    "call +1 (974) 555-3436%%% or 212-555-1212 (212) 555-1212 +44 20 7946 0958", 'token = "dafbac99949115180e7593de87b4492bcef9890b"!!',
    "TOKEN 9233A8ECF7C5B09FE5949719B6B82BC439E9329B d41d8cd98f00b204e9800998ecf8427e", "born 1980-02-29, 29.02.1981, 31/12/1999 x 2024-13-01 2024-02-30",
    "ssn 123-45-6789 666-12-1234 000-12-3456", None, "", "plain text, version 4.0 of 2024", "4111111111111111 4111111111111111",
    "4111111111111111" * 2, "é" * 1000 + " 4111111111111111 " + "x" * 1000]


def frame(spark):
    return spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)], "doc_id long, text string, pii string")


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(d[::2]) % 10 == -sum(x * 2 - 9 * (x > 4) for x in d[1::2]) % 10


def test_round_trip_formats_and_links(spark):
    df = frame(spark)
    out = pii.pseudonymise(df, key="k1").cache()
    assert out.columns == ["doc_id", "text", "pii"]
    new = [r.text for r in out.orderBy("doc_id").collect()]
    back = [r.text for r in pii.pseudonymise(out, key="k1", inverse=True).orderBy("doc_id").collect()]
    assert back[1:] == TEXTS[1:]  # e-mail codes are not undone
    assert new[8:11] == TEXTS[8:11] and new[12] == TEXTS[12]
    assert all(v not in new[0] for v in ("und.34", "A.B@")) and new[0].endswith("@X.DE.") and "@mail7.example.com" in new[0]
    ips = new[1].split()
    assert ips[1] != "233.254.104.120," and all(0 <= int(x) <= 255 for x in ips[1].strip(",").split(".")) and ips[4:] == ["999.1.1.1", "1.2.3.4.5"]
    cards = new[2].split()
    assert luhn(cards[1]) and cards[1] != "4111111111111111" and "".join(cards[2:6]) == cards[1]
    assert cards[6] == "4111111111111112" and len(cards[7]) == 15 and luhn(cards[7]) and cards[8].replace("-", "") == cards[7] and cards[9] == "0" * 16
    assert new[3].startswith("call +1 (") and new[3].endswith("0958") is False and len(new[3]) == len(TEXTS[3])
    assert len(new[4]) == len(TEXTS[4]) and new[5] == new[5].replace("?", "") and new[5].split()[1].isupper() and new[5].split()[2].islower()
    days = new[6].split()
    assert days[1] != "1980-02-29," and days[2:3] == ["29.02.1981,"] and days[5:] == ["2024-13-01", "2024-02-30"] and days[3][2] == "/"
    assert new[7].split()[2:] == ["666-12-1234", "000-12-3456"] and new[7].split()[1] != "123-45-6789"
    assert new[11].split()[0] == new[11].split()[1] == cards[1] == new[13].split()[1]
    other = [r.text for r in pii.pseudonymise(df, key="k2").orderBy("doc_id").collect()]
    assert other[2] != new[2] and other[10] == new[10]
    assert pii.pseudonymise(df.limit(0)).count() == 0


def test_feistel_is_a_bijection_of_its_domain(spark):
    for a, b in ((189, 773), (10, 100), (7, 1)):
        x = spark.range(a * b).select(pii.feistel(F.floor(F.col("id") / b), F.col("id") % b, F.lit(a), F.lit(b), "k", F.lit("t")).alias("f"))
        assert x.distinct().count() == a * b
        assert x.filter(f"f.x < 0 or f.x >= {a} or f.y < 0 or f.y >= {b}").count() == 0


def test_every_date_of_a_cycle_goes_to_a_valid_date(spark):
    days = spark.range(0, 146097, 97).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = pii.pseudonymise(days)
    assert out.select("text").distinct().count() == days.count()
    assert out.filter("to_date(text) < date'1800-01-01' or to_date(text) >= date'2200-01-01'").count() == 0


def test_phone_forms(spark):
    phones = ["+33 1 23 45 67 89", "+33 6 12 34 56 78", "+49 (0)30 1234567", "+49 30 12345-0", "+34 612 34 56 78", "+44 20 7946 0958", "+4915123456789",
              "+36 1 234 5678", "06 12 34 56 78", "01.44.55.66.77", "01-44-55-66-77", "(030) 1234567", "030 1234567", "030/1234567", "0171-1234567", "020 7946 0958",
              "089 12 34 56 78", "415.555.2671", "415 555 2671", "612 34 56 78", "91 123 45 67", "(415) 555-2671", "415-555-2671", "(030) 123-4567", "089 12 34 56"]
    others = ["01-02-2024", "05/24/1999", "03 04 2024", "01.02", "0.123 0.456", "012-34-56", "version 1.02.03", "09 30", "2024 01 02", "1 000 000", "12 500 000",
              "0-306-40615-2", "10 20 30 40", "666-12-1234"]
    texts = [f"call {p}, or {p} now." for p in phones] + [f"see {x}, then {x}." for x in others]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for key in ("k1", "k2", "k3"):
        out = pii.pseudonymise(df, key=key).orderBy("doc_id").collect()
        for p, r in zip(phones, out):
            new = r.text[5:5 + len(p)]
            assert [x.kind for x in r.pii] == ["phone"] * 2 and r.pii[0].was_valid and r.text == f"call {new}, or {new} now.", (p, r.text)
            assert new != p and [x for x in new if not x.isdigit()] == [x for x in p if not x.isdigit()]
        assert [r.text for r in out[len(phones):]] == texts[len(phones):]
        back = pii.pseudonymise(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"), key=key, inverse=True)
        assert [r.text for r in back.orderBy("doc_id").collect()] == texts


def test_what_follows_a_phone_number_is_not_taken_for_a_part_of_it(spark):
    after = {"190.137.223.204": "ip", "2024-01-02": "date", "02.01.2024": "date", "123-45-6789": "ssn", "212-555-1212": "phone", "4111 1111 1111 1111": "card",
             "4111111111111111": "card"}
    texts = [(f"{p} {x}", k) for p in ("+1 (843) 555-7672", "+33 1 23 45 67 89", "(030) 1234567", "06 12 34 56 78") for x, k in after.items()]
    out = pii.pseudonymise(spark.createDataFrame(list(enumerate(t for t, _ in texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for (t, k), r in zip(texts, out):
        assert [(x.kind, x.was_valid) for x in r.pii] == [("phone", True), (k, True)], (t, r.text)
