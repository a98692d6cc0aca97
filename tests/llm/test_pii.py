"""Formats that were missed or met before: whole texts against what must change and what must not."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from lakevault.llm import pii


def replaced(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r["text"] for r in pii.pseudonymise(rows, "key").orderBy("doc_id").collect()]


def remainder(iban):
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


ACCOUNTS = ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606",
            "MT84MALT011000012345MTLCAST001S", "NO9386011117947"]


def test_accounts_keep_their_form_and_check_digits(spark):
    texts = [f"pay to {a}, please" for a in ACCOUNTS] + ["not DE88370400440532013000 that"]
    made = replaced(spark, texts)
    assert made[-1] == texts[-1]
    for old, new in zip(ACCOUNTS, made, strict=False):
        got = new.removeprefix("pay to ").removesuffix(", please")
        assert got != old and remainder(got) == 1 and got[:2] == old[:2]
        assert [re.sub(r"\d", "0", c) for c in got] == [re.sub(r"\d", "0", c) for c in old]
    spaced = replaced(spark, ["GB29NWBK60161331926819"])[0]
    assert spaced == made[1].removeprefix("pay to ").removesuffix(", please").replace(" ", "")


def test_timestamps_numbers_keys_and_addresses(spark):
    key80, upper = "0a1b2c3d4e" * 8, "AB12" * 40
    texts = ["at 1980-05-17T00:00:00Z sharp", "1980-05-17", "call +14155552671 now", "+1 (415) 555-2671",
             "+4930123456789.", f"key {key80}!", upper, "2001:db8::ff00:42:8329",
             "2001:0DB8:0000:0000:0000:ff00:0042:8329", "::1 and fe80::1", "std::vector face::cafe 12:30:45 1::2::3"]
    made = replaced(spark, texts)
    day = made[1]
    assert made[0] == f"at {day}T00:00:00Z sharp" and day != texts[1]
    number = re.fullmatch(r"call (\+1\d{10}) now", made[2])[1]
    assert number != "+14155552671"
    assert "+" + re.sub(r"\D", "", made[3]) == number  # one number, however it is written
    assert re.fullmatch(r"\+49\d{11}\.", made[4]) and made[4] != texts[4]
    assert re.fullmatch(r"key [0-9a-f]{80}!", made[5]) and key80[:20] not in made[5]
    assert re.fullmatch("[0-9A-F]{160}", made[6]) and made[6] != upper
    assert made[7] == made[8] and re.fullmatch("(?:[0-9a-f]{4}:){7}[0-9a-f]{4}", made[7])
    assert "::1" not in made[9] and made[9].count(" and ") == 1
    assert made[10] == texts[10]


def read(text):
    """(reading, date) of a date with slashes, as the operator reads it."""
    a, b, y = map(int, text.split("/"))
    for name, (m, d) in (("day", (b, a)), ("month", (a, b))):
        try:
            return name, dt.date(y, m, d)
        except ValueError:
            pass
    return None


@pytest.mark.parametrize("years", [range(1900, 2100, 4)])
def test_slash_dates_stay_apart(spark, years):
    texts = set()
    for y in years:
        day = dt.date(y, 1, 1)
        while day.year == y:
            for a, b in ((day.day, day.month), (day.month, day.day)):
                texts |= {f"{p}/{q}/{y}" for p in {f"{a}", f"{a:02}"} for q in {f"{b}", f"{b:02}"}}
            day += dt.timedelta(1)
    texts = sorted(texts)
    made = replaced(spark, texts)
    assert len(set(made)) == len(made)  # different texts stay different
    for old, new in zip(texts, made, strict=True):
        assert [len(f) for f in old.split("/")] == [len(f) for f in new.split("/")]
        assert read(old)[0] == read(new)[0]
    iso = replaced(spark, ["1992-03-04", "04/03/1992", "31/02/1992", "45/45/1992", "01/01/2150"])
    assert dt.date.fromisoformat(iso[0]) == read(iso[1])[1]
    assert iso[2:] == ["31/02/1992", "45/45/1992", "01/01/2150"]
