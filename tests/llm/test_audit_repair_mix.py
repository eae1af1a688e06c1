"""Filter audit, conversation repair and source mix against brute force and their check SQL."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tillsight.llm import chat_repair, filter_audit, mixing

SPACE = " \t\n\x0b\x0c\r"
NAMES = ("op11_filter_audit", "op12_structure_repair", "op13_source_mixing")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_check_sql(spark, name, folder):
    folder = f"/root/testdata/{folder}"
    expected = connect(folder).sql(entry.oracle_sql()[name]).to_arrow_table()
    assert differences(entry.queries()[name](spark, folder).toArrow(), expected) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- filter audit


def documents(seed, n=150):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([0, 3, 150, 230, 400])
        vocabulary = ["a%d" % k for k in range(rng.choice([20, 400]))]
        text = rng.choice([" ", "\n", "\x0b "]).join(rng.choices(vocabulary, k=size))
        text = rng.choice([text, text, text + " #", text.upper(), "É" * 30 + text])
        if out and rng.random() < 0.4:
            text = rng.choice(out)[1]
        out.append((i, text if rng.random() > 0.03 else None, rng.choice(["en", "de", None, ""]), "x"))
    rng.shuffle(out)
    return out


def audit_by_hand(docs, labels):
    good, toxic = ({l[0] for l in labels if l[k] == 1} - {None} for k in (1, 2))
    rows, parts = [], {lang or "" for _, _, lang, *_ in docs}
    for i, text, lang, *_ in docs:
        text, w = text or "", words(text)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in docs),
        }
        rows.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = {}
    for part in parts:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [r for r in mine if f in r[1] and not before & r[1]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    sum(not before & r[1] and f not in r[1] for r in mine), len(removed),
                    sum(f in r[1] and bool(before & r[1]) for r in mine), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in removed), sum(r[3] for r in removed),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


DOCS = "doc_id long, text string, lang string, _hash string"
LABELS = "doc_id long, quality int, toxic int, lang string"


def audited(spark, docs, labels):
    counts = filter_audit.combinations(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    )
    return {(r[0], r[1], r[2]): list(r[3:]) for r in filter_audit.audit(counts).collect()}


@pytest.mark.parametrize("seed,share", [(1, 1000), (2, 5), (3, 100_000)])
def test_audit_equals_brute_force(spark, monkeypatch, seed, share):
    monkeypatch.setattr(filter_audit, "SHARE", share)  # from which share on a hash is dealt out
    docs = documents(seed)
    # one text with a third of the rows, null ids, repeated ids with equal and other texts
    docs += [(500 + i, "copy", "en", "x") for i in range(70)] + [(None, "copy", "en", "x"), (None, None, None, "x")] * 2
    docs += [docs[5], docs[5], (docs[6][0], "other", "de", "x"), (900, "word " * 50_000, "long", "x")]
    labels = [(i, i % 2, i % 3 % 2, "x") for i in range(0, 560, 2)] + [(4, 0, 1, "x"), (None, 1, 1, "x"), (6, None, None, "x")]
    assert audited(spark, docs, labels) == audit_by_hand(docs, [l[:3] for l in labels])


def test_audit_of_an_empty_table_and_without_labels(spark):
    assert audited(spark, [], []) == {}
    docs = documents(4, 20)
    assert audited(spark, docs, []) == audit_by_hand(docs, [])


# ---- conversation repair

TURNS = "conv_id long, turn long, role string, text string, part string"


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        times = 0 if kind == 0 else 2 if kind == 3 else 1
        out.append((conv, turn, "user" if kind == 4 else role, text, times))
    return out


def classes(rows):
    """(role, text, fault) of the turns of one conversation in their order."""
    def key(r):
        digest = hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()
        return (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:64].encode(), digest)

    out, seen = [], set()
    for _, turn, role, text, times in sorted(rows, key=key):
        for _ in range(times):
            bare = text.rstrip(SPACE)
            if not bare:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = None if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            out.append((turn, role, text, fault))
    return out


def repaired_by_hand(turns):
    """Cheapest edits by Dijkstra's idea over (turns read, what the initials look like)."""
    def allowed(s):
        return re.fullmatch("(s?((ua)*u?))?", s) is not None

    best = {}
    todo = [(0, "", 0, "", ())]  # cost, audit, turns read, initials, told
    while todo:
        todo.sort()
        cost, audit, n, s, told = todo.pop(0)
        state = (n, s[-1:] if s else "")
        if state in best:
            continue
        best[state] = (cost, audit, told)
        if n == len(turns) and state[1] in ("", "a"):
            return cost, audit, told
        for r in ("user", "assistant"):
            if allowed(s + r[0]):
                todo.append((cost + 3, audit + "I", n, s + r[0], told + (f"{r}:",)))
        if n < len(turns):
            _, role, text, fault = turns[n]
            todo.append((cost + 4, audit + "D", n + 1, s, told))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 * (fault == "truncated")
            if role and allowed(s + role[0]):
                todo.append((cost + extra, audit + "K", n + 1, s + role[0], told + (f"{role}:{text}",)))
            for r in ("user", "assistant"):
                if allowed(s + r[0]):
                    todo.append((cost + 3 + extra, audit + "R", n + 1, s + r[0], told + (f"{r}:{text}",)))


def conversations_by_hand(rows):
    held = defaultdict(list)
    for r in rows:
        held[r[0]].append(r)
    out = {}
    for conv, mine in held.items():
        turns = classes(mine)
        cost, audit, told = repaired_by_hand(turns)
        numbers = {t[0] for t in turns if t[0] is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        count = Counter(t[3] for t in turns)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            count["blank"], count["duplicate"], count["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(told).encode()).hexdigest(),
        )
    return out


def chats(seed, n=60):
    rng = random.Random(seed)
    out = []
    for conv in list(range(n)) + [None]:
        for turn in range(rng.choice([0, 1, 2, 5, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice(["Yes.", "No", "Why?\n", " \t", "", None, "Fine!", f"It is {turn}.", "é . "])
            number = rng.choice([turn, turn, turn, turn + 3, None, 1])
            out.append((conv, number, role, text))
    out += [(1000, t, rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", "same.", ""])) for t in range(400)]
    rng.shuffle(out)
    return out


def repaired(spark, rows, schema=TURNS):
    df = spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(3)
    done = chat_repair.repair(chat_repair.damage(df))
    told = {r.conv_id: r.sha256 for r in chat_repair.digests(done.turns).collect()}
    return {r[0]: (*r[1:], told[r[0]]) for r in done.conversations.collect()}


@pytest.mark.parametrize("seed,turns,chars", [(1, 512, 1 << 20), (2, 1, 1 << 20), (3, 3, 40)])
def test_repair_equals_brute_force(spark, monkeypatch, seed, turns, chars):
    monkeypatch.setattr(chat_repair, "SEGMENT_TURNS", turns)
    monkeypatch.setattr(chat_repair, "SEGMENT_CHARS", chars)
    rows = chats(seed)
    assert repaired(spark, rows) == conversations_by_hand(damaged_by_hand(rows))


def test_every_short_conversation_is_repaired_at_the_least_cost():
    symbols = {"s": ("system", None), "u": ("user", None), "a": ("assistant", None), "o": ("tool", None),
               "U": ("user", "truncated"), "A": ("assistant", "truncated"), "x": ("user", "blank")}
    for n in range(5):
        for told in itertools.product(symbols, repeat=n):
            turns = [(0, symbols[s][0], s, symbols[s][1]) for s in told]
            top, cost, audit = chat_repair.cheapest(chat_repair.parse("".join(told)))
            by_hand = repaired_by_hand(turns)
            assert (cost, audit) == by_hand[:2]
            made = chat_repair.rebuild([(t[1], t[2]) for t in turns], audit)
            assert tuple(f"{r}:{t}" for r, t in made) == by_hand[2]
            assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in made))


def test_repair_of_odd_tables(spark):
    assert repaired(spark, []) == {}
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(dropped, 0, "user", "Hi.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}
    long = [(3, 5, "user", "word " * 500_000 + "."), (3, 9, "assistant", "x.")]
    assert repaired(spark, long) == conversations_by_hand(damaged_by_hand(long))
    # copies of one turn in thousands, and many turns without number
    many = [(7, None, "user", "Same.")] * 3000 + [(7, None, "assistant", f"{i}.") for i in range(500)]
    assert repaired(spark, many) == conversations_by_hand(damaged_by_hand(many))


# ---- mix

SOURCES = "doc_id long, text string, source string, size string, target string"


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, full = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if each[s] > cap * sizes[s]]
        if not over:
            return {**full, **each}
        for s in over:
            full[s] = float(cap * sizes[s])
            left -= full[s]


def corpus(seed, n=200):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = rng.choice(["big"] * 5 + ["a", "b", None, "é", "Z", "tiny"])
        if source == "tiny" and any(r[2] == "tiny" for r in out):
            source = "a"
        size = rng.choice([0, 1, 7, 60, 900]) if source != "tiny" else 3
        out.append((i, " \n".join(["w"] * size) if rng.random() > 0.05 else None, source, "s", "t"))
    return out


def mixed(spark, rows, **options):
    return mixing.mix(spark.createDataFrame(rows, SOURCES).repartition(3), **options)


@pytest.mark.parametrize("seed,slot", [(1, 256), (2, 5), (3, 100_000)])
def test_mix_reaches_targets_and_reads_blocks_in_turn(spark, monkeypatch, seed, slot):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    rows = corpus(seed) + [(None, "a b c", "big", "s", "t")] * 40 + [(5000, "w " * 30_000, "long", "s", "t")]
    rows += [(3, "one two", "big", "s", "t"), (3, "one two", "big", "s", "t")]
    mix = mixed(spark, rows, slot_words=slot)
    size = Counter()
    for _, text, source, *_ in rows:
        size[source] += len(words(text))
    targets = targets_by_hand(size)
    got = {r.source: r for r in mix.sources.collect()}
    assert {s: (r.source_size, pytest.approx(r.target)) for s, r in got.items()} == {
        s: (size[s], targets[s]) for s in size
    }
    docs = mix.documents.collect()
    assert Counter((r.doc_id, r.size, r.source) for r in docs) == Counter(
        (i, len(words(t)), s) for i, t, s, *_ in rows
    )
    pieces = mix.pieces.collect()
    by_row = {r.row: r for r in docs}
    # every slot belongs to one source and takes its share of the target in one go, to the word
    filled, of = Counter(), {}
    for p in pieces:
        doc = by_row[p.row]
        assert 0 <= p.start and p.words > 0 and p.start + p.words <= doc.size
        assert of.setdefault(p.slot, doc.source) == doc.source
        filled[p.slot] += p.words
    for source, r in got.items():
        shares = [filled[s] for s in of if of[s] == source]
        assert sum(shares) == int(r.target)
        if shares and r.target >= r.slots:
            assert len(shares) == r.slots and max(shares) - min(shares) <= 1 and max(shares) <= slot + 1
    # no word of a document is read a second time before all words of its source were read once
    read = defaultdict(Counter)
    for p in pieces:
        for k in range(p.start, p.start + p.words):
            read[by_row[p.row].source][p.row, k] += 1
    for source, counter in read.items():
        rounds = got[source].target / got[source].source_size
        assert max(counter.values()) <= -(-int(got[source].target) // got[source].source_size) <= 2
        if rounds >= 1:
            assert len(counter) == got[source].source_size
    rows_out = mixing.taken(mix).collect()
    assert len(rows_out) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in rows_out)
    assert all((r.first_slot is None) == (r.taken == 0) for r in rows_out)
    # reruns agree, whatever the partitions
    again = mixing.taken(mixing.mix(spark.createDataFrame(rows[::-1], SOURCES), slot_words=slot)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows_out))


def test_slots_are_ranked_and_spread_evenly(spark):
    bits, owned = 9, [(0, 0, 100), (1, 100, 1), (2, 101, 300), (3, 401, 50)]
    df = spark.createDataFrame(owned, "place long, point long, slots long")
    rows = mixing.slots(df, bits).collect()
    slots = {r.slot: (r.place, r.block) for r in rows}
    assert len(rows) == len(slots) == 451 and max(slots) < 512
    ranks = Counter()
    for slot in sorted(slots):
        place, block = slots[slot]
        assert block == ranks[place]
        ranks[place] += 1
        # in any beginning of the schedule a source has its share, up to the digits of the point
        assert abs(ranks[place] - owned[place][2] * (slot + 1) / 512) <= bits
    assert ranks == {p: n for p, _, n in owned}


def test_mix_of_odd_tables(spark):
    assert mixing.taken(mixed(spark, [])).collect() == []
    bare = mixing.taken(mixed(spark, [(1, None, "a", "", ""), (2, " ", None, "", "")])).collect()
    assert sorted(tuple(r) for r in bare) == [(1, 0, 0, 0.0, 0, None), (2, 0, 0, 0.0, 0, None)]
    one = mixing.taken(mixed(spark, [(1, "a b c d", "x", "", "")])).collect()
    assert [tuple(r) for r in one] == [(1, 4, 4, 6.0, 6, 0)]


def test_mix_stays_in_the_jvm(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_of(mixing.taken(mixing.mix(rows)))
    assert not re.search("Arrow|Pandas|Python|CartesianProduct|NestedLoop", plan)
    assert "Join" in plan
