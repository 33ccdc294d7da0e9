"""Operator 12, conversation structure repair: the cheapest edits after which the roles alternate.

A conversation's rows, in order of turn, are kept, given another role, deleted, or preceded by inserted empty messages so
that the role initials read ``(s?(ua)+)?``: nothing, or user and assistant in turn after at most one system message. Blank
rows and rows whose role and text came before must go. Costs: keep 0, rerole 2, delete 3, insert 2, and 1 more for a row
that stays though its text does not end like a sentence. The letters of the edits in order, D I K R, are the audit; among
equally cheap repairs the one with the least audit is chosen.

A repair is a path through the states of the role pattern, and its weight is one integer: high digits hold the cost, the
``width`` low digits the audit, one digit a letter, first letter first, with zeros after the last. The least integer is
therefore the cheapest repair with the least audit, and a walk over the rows from the last to the first that takes the
minimum per state finds it; a letter put in front moves the others one digit on.

Rows are range-partitioned by conversation and turn, so one conversation may spread over any number of tasks. Most lie
within one; those are repaired on the spot. Others are cut into segments of at most ``segment_rows`` rows, and a segment
is solved for every pair of states at its ends. No audit of a segment can be the beginning of another, since inserts
stand before rows, so segments can be compared one by one: a walk over their costs and ranks, some 200 bytes a segment,
chooses the states, and then each segment is repaired by itself. Only the digest of a whole repaired conversation is
sequential by nature; :func:`report` streams the segments of one in order and holds one at a time. Rows alike in
conversation, turn, role and text are counted before any of this, so copies cost nothing.

Defined cases: a null role or text is one space; an empty role has no initial and cannot stay. Null turns come first, and
gaps ignore them; gaps beyond a long count as 0. Rows of one turn are taken by role, then by the hash of their text, copies next to each other. A null
id is a conversation like any other. A conversation without rows (``copies`` 0) has an empty audit and no messages. An
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import stored, table

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = STATES = range(4)
ANSWER = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)  # where the one message that may follow leads
SPOKEN = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
KEPT = {
    "s": (AFTER_SYSTEM, None, None, None),
    "u": (AFTER_USER, AFTER_USER, None, AFTER_USER),
    "a": (None, None, AFTER_ASSISTANT, None),
}
LEGAL = frozenset(["su", "ua", "au"])
CLOSING = {START: 0, AFTER_SYSTEM: 2, AFTER_USER: 1, AFTER_ASSISTANT: 0}  # messages still to insert at the end

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
LETTERS = " DIKR"
D, I, K, R = (LETTERS.index(c) for c in "DIKR")
BITS = 3  # of an audit digit
SPACE = " \t\n\x0b\x0c\r"


def initial(role: str) -> str:
    return role[:1] or " "


class Weights:
    """Integers that compare like (cost, audit), for audits of up to ``width`` letters."""

    def __init__(self, width: int):
        self.low = BITS * width
        self.mask = (1 << self.low) - 1
        self.never = 1 << (self.low + 62)

    def put(self, letter: int, cost: int, rest: int) -> int:
        """The weight of ``rest`` with one more edit in front."""
        digits = letter << (self.low - BITS) | (rest & self.mask) >> BITS
        return ((rest >> self.low) + cost) << self.low | digits

    def cost(self, weight: int) -> int:
        return weight >> self.low

    def audit(self, weight: int) -> str:
        digits = weight & self.mask
        out = []
        for shift in range(self.low - BITS, -1, -BITS):
            digit = digits >> shift & 7
            if not digit:
                break
            out.append(LETTERS[digit])
        return "".join(out)


def solve(rows: list[tuple[str, int]], ends: dict[int, int] | None = None) -> tuple[Weights, list[int]]:
    """The least weight from every state over all ``rows``, given as initial and fault.

    ``ends`` says which states the rows may end in, with the inserts still to follow; without it, those in which a
    conversation may end.
    """
    w = Weights(3 * len(rows) + 2)
    best = [w.never] * len(STATES)
    for state, inserts in (CLOSING if ends is None else ends).items():
        best[state] = 0
        for _ in range(inserts):
            best[state] = w.put(I, INSERT, best[state])
    for initial, fault in reversed(rows):
        row = [w.put(D, DELETE, best[s]) for s in STATES]
        if fault not in (BLANK, DUPLICATE):
            extra = UNFINISHED if fault == TRUNCATED else 0
            keep = KEPT.get(initial, ())
            for s in STATES:
                row[s] = min(row[s], w.put(R, REROLE + extra, best[ANSWER[s]]))
                if keep and keep[s] is not None:
                    row[s] = min(row[s], w.put(K, extra, best[keep[s]]))
        once = [min(row[s], w.put(I, INSERT, row[ANSWER[s]])) for s in STATES]
        best = [min(row[s], w.put(I, INSERT, once[ANSWER[s]])) for s in STATES]
    return w, best


def apply_edits(audit: str, state: int, rows: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], list[int]]:
    """The messages (role, text) that an audit makes of ``rows``, and where in the audit each row's letter stands."""
    out, places, at = [], [], 0
    for i, letter in enumerate(audit):
        if letter == "I":
            state = ANSWER[state]
            out.append((SPOKEN[state], ""))
            continue
        role, text = rows[at]
        places.append(i)
        at += 1
        if letter == "K":
            state = KEPT[role[0]][state]
            out.append((role, text))
        elif letter == "R":
            state = ANSWER[state]
            out.append((SPOKEN[state], text))
    return out, places


class Segment:
    """Consecutive distinct rows of one conversation, each with its number of copies and first fault."""

    def __init__(self):
        self.roles, self.texts, self.copies, self.faults = [], [], [], []
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, role: str, text: str, turn: int | None, copies: int, first: bool) -> None:
        seen = text.rstrip(SPACE)
        fault = BLANK if not seen else DUPLICATE if not first else TRUNCATED if seen[-1] not in ".!?" else SOUND
        if self.roles:
            self.illegal += initial(self.roles[-1]) + initial(role) not in LEGAL
        self.illegal += copies - 1  # no role may follow itself
        if turn is not None:
            if self.last_turn is None or turn != self.last_turn:
                self.turns += 1
            if self.first_turn is None:
                self.first_turn = turn
            self.last_turn = turn
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.faults.append(fault)

    def rows(self) -> list[tuple[str, int]]:
        return [(initial(r), f) for r, f in zip(self.roles, self.faults, strict=True)]

    def counts(self) -> dict[str, int]:
        """How many rows have which fault first; a second copy is a duplicate unless both are blank."""
        pairs = list(zip(self.copies, self.faults, strict=True))
        return {
            "blank": sum(n for n, f in pairs if f == BLANK),
            "duplicate": sum(n if f == DUPLICATE else n - 1 for n, f in pairs if f != BLANK),
            "truncated": sum(f == TRUNCATED for _, f in pairs),
            "illegal": self.illegal,
            "turns": self.turns,
            "first_turn": self.first_turn,
            "last_turn": self.last_turn,
        }


def repaired(roles, texts, copies, faults, start: int = START, ends: dict[int, int] | None = None) -> dict:
    """Cost, audit and messages of a segment that starts in one state and ends in one of ``ends``."""
    w, best = solve([(initial(r), f) for r, f in zip(roles, faults, strict=True)], ends)
    letters = w.audit(best[start])
    messages, places = apply_edits(letters, start, list(zip(roles, texts, strict=True)))
    audit = list(letters)
    for place, n in zip(places, copies, strict=True):
        audit[place] += "D" * (n - 1)  # every further copy is deleted, right after its first
    cost = w.cost(best[start]) + DELETE * (sum(copies) - len(copies))
    return {"cost": cost, "audit": "".join(audit), "messages": [{"role": r, "text": t} for r, t in messages]}


FACTS = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")
REPAIRED = "cost bigint, audit string, messages array<struct<role:string,text:string>>"
KEYS = ["conv_key", "turn_known", "turn0", "role", "digest"]
PLACE = ["conv_key", "at_known", "at_turn", "at_role", "at_digest"]  # of a segment: the key of its first row
PLACES = "conv_key string, at_known int, at_turn bigint, at_role string, at_digest string"
UNREACHABLE = -1


def all_ends(segment: Segment) -> tuple[list[int], list[int]]:
    """Costs from every state to every state, as a 4 x 4 table, and the ranks of the audits that leave one state."""
    solved = [solve(segment.rows(), {end: 0}) for end in STATES]
    extra = DELETE * (sum(segment.copies) - len(segment.copies))
    costs, ranks = [], []
    for start in STATES:
        weights = {s: best[start] for s, (w, best) in enumerate(solved) if best[start] < w.never}
        w = solved[0][0]
        order = sorted(weights, key=lambda s: weights[s] & w.mask)
        costs += [w.cost(weights[s]) + extra if s in weights else UNREACHABLE for s in STATES]
        ranks += [order.index(s) if s in weights else UNREACHABLE for s in STATES]
    return costs, ranks


def segments(frames: Iterator[pd.DataFrame], limit: int, columns: list[str], batch_chars: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """Ordered rows to repaired conversations, and to open segments of those that are long or at a border of the
    partition, where the next one may go on."""
    out, chars = [], 0

    def emit(segment: Segment, place: tuple, whole: bool) -> int:
        parts = (segment.roles, segment.texts, segment.copies, segment.faults)
        row = dict.fromkeys(columns) | dict(zip(PLACE, place, strict=True)) | segment.counts() | {"whole": whole}
        if whole:
            row |= repaired(*parts)
        else:
            row |= dict(zip(("roles", "texts", "copies", "faults", "costs", "ranks"), (*parts, *all_ends(segment)), strict=True))
        out.append(row)
        return sum(map(len, segment.texts)) + 100

    segment = place = None
    whole = False  # the first conversation of a partition may have begun in the one before
    for frame in frames:
        columns_in = (frame[c].tolist() for c in (*KEYS, "text", "copies", "first"))
        for *key, text, copies, first in zip(*columns_in, strict=True):
            if place is None or key[0] != place[0]:
                if place is not None:
                    chars += emit(segment, place, whole)
                    whole = True
                segment, place = Segment(), tuple(key)
            elif len(segment.roles) == limit:
                whole = False
                chars += emit(segment, place, whole)
                segment, place = Segment(), tuple(key)
            if copies:
                segment.add(key[3], text, key[2] if key[1] else None, copies, first)
            if chars > batch_chars:
                yield pd.DataFrame(out, columns=columns, dtype=object)
                out, chars = [], 0
    if place is not None:
        emit(segment, place, False)
    if out:
        yield pd.DataFrame(out, columns=columns, dtype=object)


def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The states between the segments of each conversation, from costs and ranks; segments come in order.

    Of two ways to a state the cheaper is taken, then the one that was ahead before the segment. ``breach`` and
    ``same_turn`` compare a segment's first row with the row before it.
    """
    names = [*PLACE, "segment", "start", "stop", "closing", "breach", "same_turn"]
    conversation, places, cheapest, before, role, turn = None, [], {}, [], "", None

    def chosen() -> pd.DataFrame:
        end = min(cheapest, key=lambda s: (cheapest[s][0] + INSERT * CLOSING[s], cheapest[s][1]))
        path = [end]
        for back in reversed(before):
            path.append(back[path[-1]])
        path.reverse()
        closing = [0] * (len(places) - 1) + [CLOSING[end]]
        rows = [(*p[:5], i, path[i], path[i + 1], closing[i], *p[5:]) for i, p in enumerate(places)]
        return pd.DataFrame(rows, columns=names)

    for frame in frames:
        for row in frame.itertuples():
            if row.conv_key != conversation:
                if conversation is not None:
                    yield chosen()
                conversation, places, cheapest, before, role, turn = row.conv_key, [], {START: (0, 0)}, [], "", None
            ways = {}
            for s, (cost, rank) in cheapest.items():
                for e in STATES:
                    if row.costs[4 * s + e] != UNREACHABLE:
                        way = (cost + row.costs[4 * s + e], rank, row.ranks[4 * s + e], s)
                        ways[e] = min(way, ways.get(e, way))
            order = sorted(ways, key=lambda e: ways[e][1:3])
            cheapest = {e: (ways[e][0], order.index(e)) for e in ways}
            before.append({e: ways[e][3] for e in ways})
            breach = role and row.first_role and role + row.first_role not in LEGAL
            same_turn = row.first_turn is not None and row.first_turn == turn
            places.append((*(getattr(row, c) for c in PLACE), int(bool(breach)), int(same_turn)))
            role, turn = row.last_role or role, turn if row.last_turn is None else row.last_turn
    if conversation is not None:
        yield chosen()


def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repair every open segment between its chosen states."""
    for frame in frames:
        out = []
        for row in frame.itertuples():
            parts = (list(p) for p in (row.roles, row.texts, row.copies, row.faults))
            done = repaired(*parts, row.start, {row.stop: 0})
            state = row.stop
            for _ in range(row.closing):
                state = ANSWER[state]
                done["messages"].append({"role": SPOKEN[state], "text": ""})
            audit = done["audit"] + "I" * row.closing
            out.append((row.conv_key, row.segment, done["cost"] + INSERT * row.closing, audit, done["messages"]))
        yield pd.DataFrame(out, columns=["conv_key", "segment", "cost", "audit", "messages"])


def repair(
    rows: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: str | None = None,
    segment_rows: int = 1024,
) -> DataFrame:
    """Repaired conversations in segments: ``conv_id, segment, whole, cost, audit, messages`` and counts of faults.

    ``messages`` holds ``role, text``. A conversation with ``whole`` has one segment, others several, numbered in order.
    ``copies`` names a column that says how often a row stands there, next to itself; with 0 only the conversation is
    known. Ids may be of any type that a cast to text and back leaves as it is.
    """
    n = "1" if copies is None else f"coalesce(`{copies}`, 0)"
    named = rows.select(
        F.expr(f"if(`{conv_id}` IS NULL, '', 's' || cast(`{conv_id}` AS string)) AS conv_key"),
        F.expr(f"if(`{turn}` IS NULL, 0, 1) AS turn_known"),
        F.expr(f"coalesce(cast(`{turn}` AS bigint), 0L) AS turn0"),
        F.expr(f"coalesce(cast(`{role}` AS string), ' ') AS role"),
        F.expr(f"coalesce(cast(`{text}` AS string), ' ') AS text"),
        F.expr(f"cast({n} AS bigint) AS copies"),
    )
    keyed = named.withColumn("digest", F.md5(F.encode("text", "UTF-8")))
    one = keyed.groupBy(*KEYS).agg(F.any_value("text").alias("text"), F.sum("copies").alias("copies"))
    # where a role and text are first said: joined on the key that groups the rows, so those are not shuffled again
    said = keyed.where("copies > 0").groupBy("conv_key", "role", "digest").agg(F.expr("min(struct(turn_known, turn0)) AS f"))
    said = said.selectExpr("conv_key", "f.turn_known", "f.turn0", "role", "digest", "true AS first")
    marked = one.join(said, KEYS, "left").select(*KEYS, "text", "copies", F.expr("coalesce(first, false) AS first"))
    ordered = marked.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)

    counts = ", ".join(f"{c} bigint" for c in FACTS)
    opened = "roles array<string>, texts array<string>, copies array<bigint>, faults array<int>, costs array<bigint>, ranks array<int>"
    layout = f"{PLACES}, whole boolean, {counts}, {REPAIRED}, {opened}"
    names = [f.split()[0] for f in layout.replace("struct<role:string,text:string>", "").split(", ")]
    cut, _ = stored(ordered.mapInPandas(lambda frames: segments(frames, segment_rows, names), layout), "conversations")

    split = cut.where("NOT whole")
    first, last = (f"CASE WHEN size(roles) = 0 THEN '' WHEN {r} = '' THEN ' ' ELSE left({r}, 1) END" for r in ("get(roles, 0)", "get(roles, size(roles) - 1)"))
    narrow = split.selectExpr(
        *PLACE, "costs", "ranks", "cast(first_turn AS string) AS first_turn", "cast(last_turn AS string) AS last_turn",
        f"{first} AS first_role", f"{last} AS last_role",
    )
    picked = narrow.repartition("conv_key").sortWithinPartitions(*PLACE).mapInPandas(
        choose, f"{PLACES}, segment int, start int, stop int, closing int, breach int, same_turn int"
    )
    picked, _ = stored(picked, "segments")
    done = split.select(*PLACE, "roles", "texts", "copies", "faults").join(picked, PLACE).mapInPandas(
        finish, f"conv_key string, segment int, {REPAIRED}"
    )
    known = split.join(picked, PLACE).selectExpr(
        "conv_key", "segment", "whole", "blank", "duplicate", "truncated", "illegal + breach AS illegal",
        "turns - same_turn AS turns", "first_turn", "last_turn",
    )
    known = known.join(done, ["conv_key", "segment"])
    every = cut.where("whole").withColumn("segment", F.lit(0)).select(*known.columns).unionByName(known)
    id_type = rows.schema[conv_id].dataType.simpleString()
    return every.selectExpr(
        f"if(conv_key = '', null, cast(substr(conv_key, 2) AS {id_type})) AS conv_id",
        "segment", "whole", "cost", "audit", "messages", *FACTS,
    )


def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``conv_key, audit, repaired_sha256`` of conversations whose segments come in order, one segment at a time."""
    conversation, audit, digest, any_message = None, [], sha256(), False

    def whole() -> pd.DataFrame:
        return pd.DataFrame([(conversation, "".join(audit), digest.hexdigest())], columns=["conv_key", "audit", "repaired_sha256"])

    for frame in frames:
        for row in frame.itertuples():
            if row.conv_key != conversation:
                if conversation is not None:
                    yield whole()
                conversation, audit, digest, any_message = row.conv_key, [], sha256(), False
            audit.append(row.audit)
            for message in row.messages:
                digest.update(("\n" * any_message + f"{message['role']}:{message['text']}").encode())
                any_message = True
    if conversation is not None:
        yield whole()


def report(repairs: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`: faults, cost, audit and a digest of the repaired messages."""
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")
    spread = "cast(max(last_turn) AS decimal(38,0)) - cast(min(first_turn) AS decimal(38,0)) + 1 - sum(turns)"
    gaps = f"coalesce(try_cast({spread} AS bigint), 0L) AS gaps"
    columns = ["conv_id", "gaps", *sums, "audit", "repaired_sha256"]
    alone = repairs.where("whole").selectExpr(
        "conv_id", gaps.replace("max(last_turn)", "last_turn").replace("min(first_turn)", "first_turn").replace("sum(turns)", "turns"),
        *sums, "audit",
        "sha2(array_join(transform(messages, m -> concat(m.role, ':', m.text)), '\n'), 256) AS repaired_sha256",
    )
    split = repairs.where("NOT whole").withColumn("conv_key", F.expr("if(conv_id IS NULL, '', 's' || cast(conv_id AS string))"))
    totals = split.groupBy("conv_key").agg(
        F.any_value("conv_id").alias("conv_id"), F.expr(gaps), *[F.sum(c).alias(c) for c in sums]
    )
    streamed = split.select("conv_key", "segment", "audit", "messages").repartition("conv_key")
    streamed = streamed.sortWithinPartitions("conv_key", "segment").mapInPandas(
        digests, "conv_key string, audit string, repaired_sha256 string"
    )
    return alone.select(*columns).unionByName(totals.join(streamed, "conv_key").select(*columns))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` with faults planted by a hash of conversation and turn."""
    code = "crc32(encode(coalesce(cast(conv_id AS string), ' ') || ':' || coalesce(cast(turn AS string), ' '), 'UTF-8')) % 20"
    coded = rows.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", f"{code} AS code"
    )
    return coded.selectExpr(
        "conv_id", "turn", "CASE code WHEN 0 THEN '' WHEN 4 THEN 'user' ELSE role END AS role",
        "CASE WHEN code IN (0, 1) THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text",
        "CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS copies",
    )


def op12_conversation_repair(spark, sf_dir) -> DataFrame:
    return report(repair(damaged(table(spark, sf_dir, "conversations")), copies="copies")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
