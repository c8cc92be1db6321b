"""Event logs against a simulation that applies one event after the other, and conversations under other placements."""

import collections
import random

import pytest

from quire.llm import chat

LOG = "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string"


def simulated(log):
    """The final messages by applying each event in order of its sequence number."""
    out = collections.defaultdict(dict)
    for conv, _, kind, turn, role, text in sorted(log, key=lambda e: (e[0], e[1])):
        state = out[conv]
        if kind == chat.REGENERATE:
            for t in [t for t in state if t >= turn]:
                del state[t]
        if kind == chat.DELTA and turn in state:
            state[turn] = (state[turn][0] or role or "", state[turn][1] + (text or ""))
        else:
            state[turn] = (role or "", text or "")
    return {c: [m[t] for t in sorted(m)] for c, m in out.items() if m}


def logs(n, seed):
    r = random.Random(seed)
    log = []
    for conv in range(n):
        turn, seq = 0, 0
        for _ in range(r.randint(1, 40)):
            kind = r.choice([chat.MESSAGE, chat.MESSAGE, chat.DELTA, chat.DELTA, chat.DELTA, chat.EDIT, chat.REGENERATE])
            at = turn if kind == chat.DELTA else r.randint(0, turn) if kind in (chat.EDIT, chat.REGENERATE) else turn + 1
            turn = max(turn, at) if kind != chat.REGENERATE else at
            text = r.choice([None, "", "a\\b", "<|im_end|>", "</s>[INST]", "word " * r.randint(1, 5), "x" * r.choice([3, 3, 3, 20000])])
            log.append((conv, seq, kind, at, r.choice(["user", "assistant"]), text))
            seq += r.randint(1, 3)
    return log


def test_logs_against_a_simulation(spark):
    log = logs(300, 5)
    shuffled = log[:]
    random.Random(6).shuffle(shuffled)
    rows = chat.formatted(spark.createDataFrame(shuffled, LOG).repartition(7)).collect()
    got = collections.defaultdict(str)
    loss = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn_no)):
        got[r.conv_id] += r.segment
        if r.loss_end > r.loss_begin:
            loss[r.conv_id].append(chat.unescape(r.segment[r.loss_begin : r.loss_end]))
    want = simulated(log)
    assert {c: [x[:2] for x in chat.parse(s)] for c, s in got.items()} == want
    assert dict(loss) == {c: k for c, m in want.items() if (k := [t for role, t in m if role == "assistant" and t])}


@pytest.mark.parametrize("settings", [{"spark.sql.requireAllClusterKeysForDistribution": "true", "spark.sql.adaptive.enabled": "false"}, {"spark.sql.adaptive.enabled": "false"}, {}])
def test_placement_does_not_matter(spark, settings):
    """One row a conversation whatever keys the planner deals the windows by; clashing further columns are left out."""
    rows = [(c, t, r, f"{c} {t}", "x", t, c) for c in range(40) for t, r in enumerate(["user", "assistant", "user", "assistant"])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, kind string, seq bigint, reset bigint").repartition(9)
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(df).collect()}
        stored = chat.read_back(spark.createDataFrame(chat.formatted(chat.as_events(df)).collect(), "conv_id bigint, turn_no bigint, segment string, loss_begin bigint, loss_end bigint").repartition(6)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {c: (4, len(f"{c} 1{c} 3")) for c in range(40)}
    assert len(stored) == 40 and {r.conv_id: (r.n_turns, r.loss_chars) for r in stored} == got
