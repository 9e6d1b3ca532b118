"""Streams of token events, validated and joined to texts, as they come or from a table.

A recogniser that streams a completion sends an event for each token and, where its own parser refuses the whole, an error at the
end; the tokens are then all that is left of the text. They are only taken if nothing is missing or doubtful: counts run on from
1, slot and prompt stay the same, the sampled token is the likeliest one in id, text, score and bytes, only the last token may be
empty, and the error at the end is the very one. Bytes are joined before they are decoded, as a character may be split over tokens.

Events are rows (completion_id, seq from 0, event: JSON). A completion gives one row (completion_id, content, tokens, code): its text, or
the code of the first rule that an event breaks. In a stream state is kept by completion: what it has so far and what must not
change; one that gets no event for `patience` is given up. A completion is as long as a recogniser's answer, so one key is small.

Cases: repeated, missing or disordered events break EVENT_ORDER; a null event breaks EVENT_JSON; events after the end or after a
broken rule change nothing; a completion whose events end without the error has STREAM_UNFINISHED; no events give no rows.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import DataFrame

#: The error that ends a stream whose tokens may be taken, and the fields of events (fixed values of the protocol).
TERMINAL = {"code": 500, "message": "The model produced output that does not match the expected Content-only format", "type": "server_error"}
EVENT = {"index", "content", "tokens", "stop", "tokens_predicted", "tokens_evaluated", "completion_probabilities"}
PROBABILITY = {"id", "token", "bytes", "logprob", "top_logprobs"}
SCHEMA = "completion_id string, content string, tokens int, code string"
STATE = "state string"


class Refused(ValueError):
    """An event breaks a rule; its code."""


def whole(value, least: int = 0) -> bool:
    return type(value) is int and value >= least


def need(condition: bool, code: str) -> None:
    if not condition:
        raise Refused(code)


@dataclass
class Completion:
    """What a completion has so far: events and tokens read, its bytes, and what later events have to repeat."""

    seq: int = 0
    tokens: int = 0
    output: str = ""  # base64, so that the state is text
    fixed: str | None = None
    empty: bool = False
    stray: bool = False
    code: str | None = None
    done: bool = False

    def read(self, seq: int, event: str | None, terminal: dict, most: int) -> None:
        if self.done:
            return
        try:
            need(seq == self.seq, "EVENT_ORDER")
            self.seq += 1
            value = parsed(event)
            if "error" in value:
                need(value == {"error": terminal} and type(value["error"]["code"]) is int, "TERMINAL_ERROR")
                self.finish()
            else:
                self.token(value, most)
        except Refused as refusal:
            self.code, self.done = str(refusal), True

    def token(self, event: dict, most: int) -> None:
        need(not self.empty, "BYTES_EMPTY")  # only the last token may be
        need(set(event) - {"id_slot"} == EVENT, "EVENT_FIELDS")
        need(event["index"] == 0 and event["stop"] is False and isinstance(event["content"], str), "EVENT_STATE")
        slot = event.get("id_slot")
        need(slot is None or type(slot) is int, "SLOT_INVALID")
        need(whole(event["tokens_predicted"], 1) and event["tokens_predicted"] == self.tokens + 1 <= most, "TOKEN_COUNT")
        need(whole(event["tokens_evaluated"], 1), "PROMPT_COUNT")
        fixed = json.dumps(["id_slot" in event, slot, event["tokens_evaluated"]])
        need(self.fixed in (None, fixed), "SLOT_CHANGED")
        emitted = sampled(event)
        self.tokens, self.fixed, self.empty, self.stray = self.tokens + 1, fixed, not emitted, not emitted and event["content"] != ""
        self.output = base64.b64encode(base64.b64decode(self.output) + emitted).decode()

    def finish(self) -> None:
        need(self.tokens > 0, "NO_TOKENS")
        need(not self.stray, "BYTES_EMPTY")
        need(bool(self.text().strip()), "OUTPUT_EMPTY")
        self.done = True

    def text(self) -> str:
        return base64.b64decode(self.output).decode("utf-8", errors="replace")

    def row(self, key: str) -> tuple:
        code = self.code if self.done else "STREAM_UNFINISHED"
        return key, self.text() if code is None else None, self.tokens, code


def parsed(event: str | None) -> dict:
    """An event's JSON object; a key that repeats is an error."""

    def once(pairs):
        need(len(pairs) == len({k for k, _ in pairs}), "EVENT_JSON")
        return dict(pairs)

    try:
        value = json.loads(event or "", object_pairs_hook=once)
    except (TypeError, ValueError) as error:
        raise Refused("EVENT_JSON") from error
    need(isinstance(value, dict), "EVENT_JSON")
    return value


def sampled(event: dict) -> bytes:
    """The bytes of an event's only token, which is sampled and likeliest alike."""
    tokens, found = event["tokens"], event["completion_probabilities"]
    need(isinstance(tokens, list) and len(tokens) == 1 and whole(tokens[0]), "TOKEN_ID")
    need(isinstance(found, list) and len(found) == 1 and isinstance(found[0], dict) and set(found[0]) == PROBABILITY, "PROBABILITY_FIELDS")
    top = found[0]["top_logprobs"]
    need(isinstance(top, list) and len(top) == 1 and isinstance(top[0], dict) and set(top[0]) == PROBABILITY - {"top_logprobs"}, "PROBABILITY_FIELDS")
    for held in (found[0], top[0]):
        need(type(held["id"]) is int and held["id"] == tokens[0], "TOKEN_ID")
        score = held["logprob"]
        need(type(score) in (int, float) and math.isfinite(score), "SCORE_INVALID")
        need(isinstance(held["token"], str), "PROBABILITY_FIELDS")
        octets(held["bytes"])
    need(all(found[0][k] == top[0][k] for k in ("token", "logprob", "bytes")), "TOP_TOKEN_DIFFERS")
    return bytes(found[0]["bytes"])


def octets(value) -> bytes:
    """A list of whole numbers below 256 as bytes."""
    need(isinstance(value, list) and set(map(type, value)) <= {int}, "BYTES_INVALID")
    try:
        return bytes(value)
    except (OverflowError, ValueError) as error:
        raise Refused("BYTES_INVALID") from error


def completions(events: DataFrame, terminal: dict | None = None, most_tokens: int = 1 << 20) -> DataFrame:
    """(completion_id, content, tokens, code) of the completions of a table of events."""
    end = terminal or TERMINAL

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held = Completion()
        for seq, event in frame.sort_values("seq", kind="stable")[["seq", "event"]].itertuples(index=False):
            held.read(int(seq), event, end, most_tokens)
        return pd.DataFrame([held.row(key[0])], columns=["completion_id", "content", "tokens", "code"])

    return events.select("completion_id", "seq", "event").groupBy("completion_id").applyInPandas(run, SCHEMA)


def completion_stream(events: DataFrame, patience_ms: int = 600_000, terminal: dict | None = None, most_tokens: int = 1 << 20) -> DataFrame:
    """The same of a stream of events, each completion when it is decided. One that gets no event for patience_ms of processing
    time is unfinished. A decided completion stays known for as long, so that what comes after its end changes nothing."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    end = terminal or TERMINAL

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = Completion(**json.loads(state.get[0])) if state.exists else Completion()
        before = held.done
        if state.hasTimedOut:
            state.remove()
            if not before:
                yield pd.DataFrame([held.row(key[0])], columns=["completion_id", "content", "tokens", "code"])
            return
        for seq, event in pd.concat(list(frames)).sort_values("seq", kind="stable")[["seq", "event"]].itertuples(index=False):
            held.read(int(seq), event, end, most_tokens)
        if held.done:
            decided = held.row(key[0])
            held.output = ""
        state.update((json.dumps(asdict(held)),))
        state.setTimeoutDuration(patience_ms)
        if held.done and not before:
            yield pd.DataFrame([decided], columns=["completion_id", "content", "tokens", "code"])

    grouped = events.select("completion_id", "seq", "event").groupBy("completion_id")
    return grouped.applyInPandasWithState(run, SCHEMA, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
