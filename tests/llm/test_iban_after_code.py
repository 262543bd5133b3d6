"""A code in upper case before an IBAN, or one IBAN right after another, does not hide it."""

import time

from crossroads.llm import pii

DE, GB = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"


def ibans(text):
    return [text[a:b] for k, a, b, _ in pii.spans(text) if k == "iban"]


def test_code_before_the_number():
    text = f"REF AB12 IBAN {DE} paid"
    assert ibans(text) == [DE]
    assert DE not in pii.mask(text)
    assert ibans(f"AB12 CD34 EF56 {DE}") == [DE]
    assert ibans(f"AB12 IBAN DE89370400440532013001 IBAN {GB}") == [GB]


def test_two_numbers_in_a_row():
    assert ibans(f"{DE} {GB}") == [DE, GB]
    assert ibans(f"{GB} {DE} AND MORE") == [GB, DE]


def test_long_runs_of_codes_stay_linear():
    began = time.perf_counter()
    assert ibans("AB12 " * 20_000 + DE) == [DE]
    assert time.perf_counter() - began < 20
