from pasarlens.llm.pii import KINDS, base_spans, candidates


def possible(text):
    found = candidates(text, base_spans(text))
    return {(KINDS[c["kind"]], text[c["start"] : c["end"]]) for c in found if c["label"] != 0}


def test_numbers_side_by_side_are_proposed_one_by_one():
    assert {("card", "7536784127813050"), ("card", "4845168114407329")} <= possible("pay 7536784127813050 4845168114407329 now")
    both = possible("call +1 (826) 555-4081 190.137.223.204 today")
    assert {("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204")} <= both
    assert ("phone", "826-555-4081") in possible("826-555-4081 7536784127813051")


def test_long_rows_have_candidates():
    row = " ".join(["10 20 30 40"] * 20 + ["4111 1111 1111 1111"] + ["50 60"] * 20)
    assert ("card", "4111 1111 1111 1111") in possible(row)


def test_windows_grow_with_the_row():
    text = "12 " * 20_000
    assert len(candidates(text, base_spans(text))) <= 7 * 20_000
