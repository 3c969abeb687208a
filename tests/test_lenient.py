import pytest

from dialoom.functions.lenient import audio_verdict, json_object, text_verdict, truth, whole


@pytest.mark.parametrize(
    "raw,want",
    [
        (None, (None, "", [], "empty model text")),
        (" 　", (None, "", [], "empty model text")),
        ('{"passed": true} {"passed": false}', (True, "", [], "regex passed fallback only")),
        ('{"passed": false, "passed": true}', (True, "", [], None)),
        ('{"passed": NaN}', (None, "", [], "missing passed field")),
        ('[{"passed": true, "issues": [null, 1]}]', (True, "", ["1"], None)),
        ('{"passed": "不", "summary": " s ", "issues": {"a": 1}}', (False, "s", [], None)),
        ('```JSON\n{"passed": 1.0}```', (True, "", [], None)),
        ("passed: false", (False, "", [], "regex passed fallback only")),
        ('{"passed": true或false', (True, "", [], "failed to parse")),
    ],
)
def test_text_verdicts(raw, want):
    got = text_verdict(raw)
    if want[3] == "failed to parse":
        assert got[0] is None and got[3].startswith("failed to parse")
    else:
        assert got == want


def test_a_false_from_the_stripped_text_lets_the_raw_text_speak():
    assert text_verdict("``` passed: false ```")[0] is False


def test_audio_verdicts():
    assert audio_verdict('{"is_pass": true, "scores": {"clarity": "-1", "emotion": true, "naturalness": 4.5}} // ok') == (True, (-1, None, None), "", [], None)
    assert audio_verdict('{"is_pass": true, "review_summary": "http://x"}')[4] == "regex is_pass fallback only"
    assert audio_verdict('say {"is_pass": "No"}')[0] is False


def test_values():
    assert [truth(x) for x in (True, 0, 2, 1.0, "YES ", "通过", None, [])] == [True, False, None, True, True, True, None, None]
    assert [whole(x) for x in (True, 3, 3.0, 3.5, " -7", "--7", "٣", float("inf"), None)] == [None, 3, 3, None, -7, None, 3, None, None]
    assert json_object('x {"a": "é"} y') == ('{"a": "é"}', None) and json_object("[]")[1] == "parsed JSON is not an object"
