"""Token event streams: good ones and each kind of damage, from a table and as a stream."""

import copy
import json

import pytest

from corpusflow.streaming import completions as C

TEXT = "né \U0001f600 end"


def events(text=TEXT, slot=True):
    """An event for every byte, so that characters are split, an empty last token, and the error that ends the stream."""
    out = []
    for k, b in enumerate([*text.encode(), None], 1):
        held = {"id": 7 + k, "token": "x", "bytes": [] if b is None else [b], "logprob": -0.5}
        e = {"index": 0, "content": "", "tokens": [7 + k], "stop": False, "tokens_predicted": k, "tokens_evaluated": 11, "completion_probabilities": [{**held, "top_logprobs": [copy.deepcopy(held)]}]}
        out.append({**e, "id_slot": 3} if slot else e)
    return [*out, {"error": dict(C.TERMINAL)}]


def change(path, value, at=1):
    def run(es):
        node = es[at]
        for p in path[:-1]:
            node = node[p]
        if value is None:
            del node[path[-1]]
        else:
            node[path[-1]] = value
        return es

    return run


P = ("completion_probabilities", 0)
DAMAGE = {
    "count": (change(["tokens_predicted"], 5), "TOKEN_COUNT"), "true": (change(["tokens_predicted"], True, 0), "TOKEN_COUNT"), "prompt": (change(["tokens_evaluated"], 0, 0), "PROMPT_COUNT"),
    "prompt changed": (change(["tokens_evaluated"], 12), "SLOT_CHANGED"), "slot": (change(["id_slot"], 4), "SLOT_CHANGED"), "slot gone": (change(["id_slot"], None), "SLOT_CHANGED"), "slot text": (change(["id_slot"], "3"), "SLOT_INVALID"),
    "field": (change(["more"], 1), "EVENT_FIELDS"), "stop": (change(["stop"], True), "EVENT_STATE"), "missing": (change(["content"], None), "EVENT_FIELDS"), "ids": (change(["tokens"], [1, 2]), "TOKEN_ID"), "other id": (change([*P, "id"], 1), "TOKEN_ID"),
    "top": (change([*P, "top_logprobs", 0, "token"], "y"), "TOP_TOKEN_DIFFERS"), "score": (change([*P, "logprob"], -0.4), "TOP_TOKEN_DIFFERS"), "nan": (change([*P, "logprob"], float("nan")), "SCORE_INVALID"), "bytes": (change([*P, "bytes"], [256]), "BYTES_INVALID"),
    "no bytes": (lambda es: change([*P, "top_logprobs", 0, "bytes"], [])(change([*P, "bytes"], [])(es)), "BYTES_EMPTY"), "stray": (change(["content"], "z", -2), "BYTES_EMPTY"), "two": (lambda es: [es[0], es[0], *es[1:]], "TOKEN_COUNT"),
    "end": (change(["error", "code"], 501, -1), "TERMINAL_ERROR"), "end true": (change(["error", "more"], 1, -1), "TERMINAL_ERROR"), "nothing": (lambda es: es[-1:], "NO_TOKENS"), "cut": (lambda es: es[:-1], "STREAM_UNFINISHED"), "early": (lambda es: [es[0], es[-1], *es[1:]], None),
}


def rows():
    out, want = [], {}
    for name, (damage, code) in {"good": (lambda es: es, None), **DAMAGE}.items():
        es = damage(events())
        out += [(name, k, json.dumps(e)) for k, e in enumerate(es)]
        want[name] = (None if code else "n" if name == "early" else TEXT, code)
    for name, lines, code in (
        ("no slot", [json.dumps(e) for e in events(slot=False)], None), ("twice", ['{"index": 0, "index": 0}'], "EVENT_JSON"), ("null", [None], "EVENT_JSON"), ("list", ["[]"], "EVENT_JSON"),
        ("blank", [json.dumps(e) for e in events("  ")], "OUTPUT_EMPTY"), ("cut character", [json.dumps(e) for e in [*events("aé")[:2], events("aé")[-1]]], None),
    ):
        out += [(name, k, x) for k, x in enumerate(lines)]
        want[name] = ({"no slot": TEXT, "cut character": "a�"}.get(name) if not code else None, code)
    gap = [json.dumps(e) for e in events()]
    out += [("gap", k, x) for k, x in enumerate(gap) if k != 1] + [("again", k, x) for k, x in [*enumerate(gap), (0, gap[0])]]
    return out, want | {"gap": (None, "EVENT_ORDER"), "again": (None, "EVENT_ORDER")}


def test_each_damage_has_its_code(spark):
    held, want = rows()
    frame = spark.createDataFrame(held, "completion_id string, seq long, event string").repartition(5)
    got = {r["completion_id"]: (r["content"], r["code"]) for r in C.completions(frame).collect()}
    assert got == want
    assert C.completions(frame.limit(0)).collect() == []
    assert C.completions(frame.where("completion_id = 'good'"), most_tokens=3).first()["code"] == "TOKEN_COUNT"


@pytest.mark.parametrize("size", [1, 4])
def test_a_stream_gives_the_same(spark, tmp_path, size):
    held, want = rows()
    schema = "completion_id string, seq long, event string"
    deal = {}
    for r in held:
        deal.setdefault(r[1] * size // 12, []).append(r)
    for k, part in sorted(deal.items()):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k:03d}")
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    seen = []
    out = C.completion_stream(files, patience_ms=2_000 if size == 1 else 600_000)
    query = out.writeStream.foreachBatch(lambda df, _: seen.extend(df.collect())).option("checkpointLocation", f"{tmp_path}/state").start()
    undecided = set() if size == 1 else {k for k, (_, code) in want.items() if code == "STREAM_UNFINISHED"}  # until patience ends
    try:
        for _ in range(200):
            if len(seen) >= len(want) - len(undecided):
                break
            query.awaitTermination(0.3)
    finally:
        query.stop()
    got = {r["completion_id"]: (r["content"], r["code"]) for r in seen}
    # over several batches a repeated event may come after the end, where it changes nothing
    told = {k: v for k, v in want.items() if k not in undecided} | ({} if size == 1 else {"again": got.get("again")})
    assert len(seen) == len(got) and got == told and got["again"] in ((None, "EVENT_ORDER"), (TEXT, None))
