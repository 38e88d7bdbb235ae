"""The quarantine against ``json.loads`` on a corpus of odd lines."""

import json
import random

from conftest import lines_df

from eventlens.sources.json_scan import parse_events, valid_variants
from eventlens.sources.lines import strip_lines

#: Lines that json.loads reads and the library does not, with the reason (README).
STRICTER = {
    '{"a":NaN}': "invalid_json",
    '{"a":Infinity}': "invalid_json",
    '{"a":-Infinity}': "invalid_json",
    '{"id":"1","payload":{"size":NaN}}': "invalid_json",
}

CORPUS = [
    "{}", "{ }", '{"a":1}', '{"a" : [1, 2.5e3, -0, 0.0, 1E5]}', '{"a":null,"b":true,"c":false}', '{"a":""}', '{"":1}', '{"a":1,"a":2}',
    "{'id':'1'}", "{'a':1}", '{"a":\'b\'}', "{a:1}", '{"a":1,}', '{"a":,}', '{"a"}', '{"a":}', "{,}", '{"a":1 "b":2}', '{"a":[1,]}', '{"a":[,1]}',
    '{"a":01}', '{"a":-}', '{"a":+1}', '{"a":.5}', '{"a":1.}', '{"a":1e}', '{"a":0x1}', '{"a":1_0}', '{"a":--1}',
    '{"a":"\x01"}', '{"a":"b\tc"}', '{"a":"\\x41"}', '{"a":"\\u12"}', '{"a":"\\u00e9"}', '{"a":"\\ud83d\\ude00"}', '{"a":"\\/"}', '{"a":"b\\"}',
    '{"a":1} // c', '{"a":/* c */1}', '{"a":1}#', '# {"a":1}', '{"a":1}{"b":2}', '{"a":1} {"b":2}', '{"a":1},{"b":2}', '{"a":1}]', '{"a":1}}', '{"a":1}] [{"b":2}',
    '{"a":1},0] [{"b":2}', '{"a":1},', '{"a":1};', '{"a":True}', '{"a":undefined}', '{"a":nul}', '{"a":tru}', '{"a":"é ü 漢 😀"}',
    '{"a":123456789012345678901234567890}', '{"a":1e400}', '{"a":-1e-400}', '{"a":' + "9" * 60 + "}", '{"a":' + "[" * 200 + "]" * 200 + "}", '{"a":"' + "x" * 70000 + '"}',
    '{"a":\x0b1}', '{"a":\u00a01}', '\ufeff{"a":1}', '{"a":1}\x00', '{"a":"\x7f"}', '{"a":"\u2028"}',
    *STRICTER,
]


def reads(line):
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


def mutated(seed=11, n=400):
    rng = random.Random(seed)
    base = ['{"id":"1","type":"PushEvent","payload":{"size":3,"commits":[{"sha":"a"},null,true]},"x":[-1.5e2,""]}', '{"a":{"b":[{},[],"\\n"]}}']
    out = []
    for _ in range(n):
        line = list(rng.choice(base))
        for _ in range(rng.randint(1, 2)):
            i = rng.randrange(len(line))
            line[i : i + rng.randint(0, 2)] = rng.choice(["", "'", '"', ",", "}", "]", "{", "[", ":", "0", "-", "\\", " ", "\t", "NaN", "e", "."])
        out.append("".join(line))
    return [x.strip() for x in out if "NaN" not in x or not reads(x)]


def test_verdicts_are_those_of_json_loads(spark):
    lines = [x for x in dict.fromkeys([*CORPUS, *mutated()]) if x]
    parsed = {r["line"]: (r["valid"], r["reason"]) for r in parse_events(lines_df(spark, lines)).collect()}
    wrong = {x: parsed[x] for x in lines if x not in STRICTER and parsed[x][0] != reads(x)}
    # a field of a wrong kind makes an event invalid, not the JSON
    assert {x: r for x, r in wrong.items() if r[1] != "bad_field_type"} == {}
    assert {x: parsed[x][1] for x in STRICTER} == STRICTER
    assert all((r is None) == v for v, r in parsed.values())


def test_envelope_and_schema_agree_on_every_line(spark):
    lines = [x for x in dict.fromkeys([*CORPUS, *mutated(12)]) if x]
    lines += ['{"actor":0.0}', '{"actor":-0}', '{"actor":"0"}', '{"actor":{}}', '{"repo":[]}', '{"repo":[1]}', '{"actor":0e5}', '{"actor":0.1}', '{"repo":false}']
    df = lines_df(spark, lines)
    assert valid_variants(df).count() == parse_events(df).where("valid").count()


def test_white_space_of_any_alphabet_is_stripped(spark):
    pads = ["\u00a0", "\x85", "\x1c", "\x1d", "\x1e", "\x1f", "\u1680", "\u2000", "\u200a", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\t", "\x0b", "\x0c"]
    lines = [f'{p} {{"id":"{i}"}}{p}' for i, p in enumerate(pads)] + pads + ["\u200b"]
    got = [r["value"] for r in strip_lines(lines_df(spark, lines)).collect()]
    assert got == [x.strip() for x in lines if x.strip()]
    assert parse_events(strip_lines(lines_df(spark, lines))).where("valid").count() == len(pads)
