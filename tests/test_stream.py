"""The streaming consolidation: scenarios batch by batch, then real queries with failures and restarts."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from accrue.operators.quality import differences
from accrue.plans import TAXES, consolidate
from accrue.sources.schemas import CHANGES, FACTS
from accrue.streaming import TRIGGER, Consolidation, KeyedTable, Progress, StateMismatch, run_with_restarts
from accrue.streaming.admission import NEVER, micros
from accrue.streaming.live import GroupState
from conftest import fact, line_set

M = datetime(2024, 5, 6, 15, 0, 0)
PLATA, ANDINO, SUR, NOBODY = "30123456781", "33123456780", "23123456783", "20123456786"
KEYS = TAXES.line_keys


def s(seconds):
    return M + timedelta(seconds=seconds)


def tick(id, at):
    return fact(id, NOBODY, "PER_IVA", "21.00", "1.00", "0.21", at)


class Run:
    """Micro-batches admitted by hand, and the second query run to its end after each; the clock moves ``pace`` seconds per batch."""

    def __init__(self, spark, folder, facts_of, log_of, pace=10.0, **options):
        self.spark, self.facts_of, self.log_of = spark, facts_of, log_of
        self.target = KeyedTable(spark, f"{folder}/target", KEYS)
        self.now, self.pace, self.number = 0.0, pace, 0
        self.job = Consolidation(spark, f"{folder}/checkpoint", self.target, clock=lambda: self.now, **options)

    def admit(self, *facts, changes=()):
        batch = self.job.admission.tagged(self.facts_of(*facts), self.log_of(*changes))
        self.job.admission.process(batch, self.number)
        self.number += 1
        self.now += self.pace

    def feed(self, *facts, changes=()):
        self.admit(*facts, changes=changes)
        return self.lines()

    def lines(self):
        self.job.consolidate(None).awaitTermination()
        df = self.target.read()
        return set() if df is None else line_set(df)


@pytest.fixture
def run(spark, tmp_path, facts_of, log_of):
    return lambda name="run", **options: Run(spark, f"{tmp_path}/{name}", facts_of, log_of, **options)


def test_a_line_grows_live(run):
    r = run()
    r.admit()  # an empty batch starts the clock, so the change input is idle from here on
    assert r.feed(fact(1, NOBODY, "RET_IVA", "5.00", "1000.00", "50.00", s(10))) == set()
    assert r.feed(tick(2, s(15))) == {(NOBODY, "RET_IVA", "5.00", M, None, "1000.00", "50.00")}
    r.feed(fact(3, NOBODY, "RET_IVA", "5.00", "500.00", "25.00", s(13)))
    # on time, and the watermark (s(15) - 5 s) has not passed it
    assert r.feed() == {(NOBODY, "RET_IVA", "5.00", M, None, "1000.00", "50.00")}
    assert r.feed(tick(4, s(18))) == {(NOBODY, "RET_IVA", "5.00", M, None, "1500.00", "75.00")}
    # now too late
    r.feed(fact(5, NOBODY, "RET_IVA", "5.00", "7.00", "0.35", s(12)))
    assert r.feed(tick(6, s(100))) == {(NOBODY, "RET_IVA", "5.00", M, None, "1500.00", "75.00")}


def test_eager_emission(run):
    r = run(emit="eager")
    assert r.feed(fact(1, NOBODY, "RET_IVA", "5.00", "1000.00", "50.00", s(10))) == {
        (NOBODY, "RET_IVA", "5.00", M, None, "1000.00", "50.00")
    }


def test_enrichment_is_decided_once(run):
    r = run()
    r.feed(changes=[(PLATA, "Plata", "10001", "r", s(0), 1), (ANDINO, "Andino", "10002", "r", s(0), 2)])
    r.feed(fact(1, PLATA, "RET_IVA", "6.75", "1500.75", "101.30", s(10)), fact(2, ANDINO, "RET_IVA", "2.00", "1000.00", "20.00", s(11)))
    first = r.feed(tick(3, s(20)))
    assert first == {
        (PLATA, "RET_IVA", "6.75", M, "Plata", "1500.75", "101.30"),
        (ANDINO, "RET_IVA", "2.00", M, "Andino", "1000.00", "20.00"),
    }
    # changes with earlier times that arrive after the release touch nothing
    assert r.feed(changes=[(PLATA, "Rewritten", "1", "u", s(5), 3), (ANDINO, "Andino Express", "10999", "u", s(30), 4)]) == first
    r.feed(fact(4, ANDINO, "RET_IVA", "2.00", "500.00", "10.00", s(35)))
    second = r.feed(tick(5, s(70)))
    assert second == {
        (PLATA, "RET_IVA", "6.75", M, "Plata", "1500.75", "101.30"),
        (ANDINO, "RET_IVA", "2.00", M, "Andino Express", "1500.00", "30.00"),
    }
    r.feed(changes=[(ANDINO, None, None, "d", s(71), 5)])
    r.feed(fact(6, ANDINO, "RET_IVA", "2.50", "800.00", "20.00", s(75)))
    assert r.feed(tick(7, s(90))) == second | {(ANDINO, "RET_IVA", "2.50", s(60), None, "800.00", "20.00")}


def test_each_column_of_a_line_keeps_its_own_last_value(run):
    r = run()
    r.admit(changes=[(PLATA, "Plata", "10001", "r", s(0), 1), (PLATA, None, "10999", "u", s(20), 2)])
    r.admit(fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10)), fact(2, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(30)))
    r.feed(tick(3, s(100)))
    assert [(x.merchant_name, x.establishment) for x in r.target.read().collect()] == [("Plata", "10999")]


def test_an_enriched_line_keeps_its_name_when_bare_facts_follow(run):
    r = run()
    r.feed(changes=[(PLATA, "Plata", "10001", "r", s(0), 1)])
    r.feed(fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10)), tick(2, s(16)))
    r.feed(changes=[(PLATA, None, None, "d", s(20), 2)])
    assert r.feed(fact(3, PLATA, "RET_IVA", "3.50", "2.00", "0.07", s(25)), tick(4, s(40))) == {
        (PLATA, "RET_IVA", "3.50", M, "Plata", "3.00", "0.11")
    }


def test_an_active_dimension_holds_facts_back_and_an_idle_one_does_not(run):
    change = (PLATA, "Plata", "10001", "r", s(0), 1)
    rows = (fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10)), tick(2, s(60)))
    active = run("active", pace=1.0)
    active.admit(*rows, changes=[change])  # watermark s(0) - 5 s
    active.admit(tick(3, s(61)))
    assert active.feed(tick(4, s(62))) == set()
    assert len(active.feed(tick(5, s(63)))) == 1  # silent for more than 2 s
    assert active.job.progress().watermark == s(58)
    idle = run("idle")
    idle.admit(*rows, changes=[change])
    assert len(idle.feed(tick(3, s(61)))) == 1


def test_an_idle_dimension_is_found_out_without_records(run):
    r = run("beats", pace=1.0)
    r.admit(changes=[(PLATA, "Plata", "10001", "r", s(0), 1)])
    r.admit(fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10)), tick(2, s(60)))
    assert r.feed() == set()  # heartbeats alone from here on
    assert len(r.feed()) == 1  # the dimension is idle, the facts are not yet
    both = run("both", pace=3.0)
    both.admit(fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10)), tick(2, s(60)), changes=[(PLATA, "Plata", "10001", "r", s(0), 1)])
    both.admit()
    assert both.feed() == set()  # both went idle at once: nothing moves


def test_progress_rules():
    a = Progress().advance(0, s(10), None, 5, 2)
    assert a.watermark is None  # the dimension may still deliver
    b = a.advance(1, s(20), s(8), 5, 2)
    assert b.watermark == s(3)
    c = b.advance(10, None, None, 5, 2)
    assert c.watermark == s(3)  # all idle: nothing moves
    d = c.advance(11, s(19), None, 5, 2)
    assert (d.newest_fact, d.watermark) == (s(20), s(15))
    e = d.advance(12, None, s(9), 5, 2)
    assert e.watermark == s(15)  # never back
    assert Progress.from_json(e.to_json()) == e


def test_replaying_a_batch_changes_nothing(run):
    r = run()
    rows = [fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10)), tick(2, s(20))]
    r.admit(changes=[(PLATA, "Plata", "10001", "r", s(0), 1)])
    before = r.feed(*rows)
    r.now += 1000
    r.number = 1
    assert r.feed(*rows) == before
    assert r.feed(fact(3, PLATA, "RET_IVA", "3.50", "2.00", "0.07", s(21)), tick(4, s(40))) == {
        (PLATA, "RET_IVA", "3.50", M, "Plata", "3.00", "0.11")
    }


def test_a_replay_that_was_cut_off_admits_what_was_decided(run):
    r = run()
    r.admit()
    change = (PLATA, "Plata", "10001", "r", s(0), 1)
    batch = r.job.admission.tagged(r.facts_of(fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10)), tick(2, s(20))), r.log_of(change))
    admission = r.job.admission
    admission._advance(batch, 1)  # recorded, and then the driver was lost
    decided = admission.progress()
    r.now += 1000
    admission.process(batch, 1)
    assert admission.progress() == decided
    r.number = 2
    assert len(r.feed(tick(3, s(60)))) == 1


def random_history(seed):
    rng = random.Random(seed)
    keys = [PLATA, ANDINO, SUR, NOBODY]
    facts = []
    for i in range(120):
        tax, rate = rng.choice([("RET_IVA", "3.50"), ("RET_IVA", "5.00"), ("PER_IVA", "21.00")])
        facts.append(fact(i, rng.choice(keys), tax, rate, f"{rng.randrange(1, 9999)}.{rng.randrange(100):02}", "1.00", s(i * 2 - rng.randrange(9))))
    changes = [(k, f"{k}-{v}", str(v), "u", s(rng.randrange(-10, 260)), v) for v, k in enumerate(keys[:3] * 3)]
    changes.append((SUR, None, None, "d", s(120), 99))
    return facts, changes


@pytest.mark.parametrize("cuts, shards", [([40, 41], 3)])
def test_any_split_into_micro_batches_gives_the_batch_result(spark, run, facts_of, log_of, cuts, shards):
    facts, changes = random_history(len(cuts))
    r = run(pace=10.0, shards=shards)
    r.admit(changes=changes)
    for a, b in zip([0, *cuts], [*cuts, len(facts)]):
        r.feed(*facts[a:b])
    unflushed = consolidate(facts_of(*facts), log_of(*changes), flush=False)
    assert differences(unflushed, r.target.read(), KEYS).collect() == []
    # the state holds what can still change, and nothing else
    held = r.job.state().collect()
    mark = micros(r.job.progress().watermark)
    assert all(w.at > mark for h in held for w in h.waiting)
    mark -= 5_000_000
    assert all(x.end > mark for h in held for x in h.lines)
    assert all(sum(max(v.at, v.before) <= mark for v in h.versions) <= 1 for h in held)
    r.job.finish(attempts=1)
    got, expected = r.target.read(), consolidate(facts_of(*facts), log_of(*changes))
    assert got.columns == expected.columns and got.count() > 10
    assert differences(expected, got, KEYS).collect() == []
    with pytest.raises(StateMismatch, match="finished"):
        r.admit(*facts[:1])


class Store:
    """State variables and timers of one group, counting the calls."""

    def __init__(self):
        self.values, self.timers, self.calls = {}, [], 0

    def getValueState(self, name, schema):
        store = self

        class Value:
            def get(self):
                store.calls += 1
                return store.values.get(name)

            def update(self, value):
                store.calls += 1
                store.values[name] = value

            def clear(self):
                store.calls += 1
                store.values.pop(name)

        return Value()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


def test_a_group_takes_few_calls_into_the_state_however_many_keys_it_holds():
    store, second = Store(), 1_000_000
    group = GroupState(1, 1, eager=False, delay=5 * second)
    group.init(store)
    now = type("Now", (), {"ms": 0, "getCurrentWatermarkInMs": lambda self: self.ms})()
    change = [(0, str(i), 0, 1, 10 * second, 0, i, NEVER, True, None, 0, 0, 0, f"n{i}", None) for i in range(500)]
    fact = [(0, str(i), 0, 0, (20 + i) * second, 1, 0, 0, False, "x", 0, 3600 * second, i, None, None) for i in range(100)]
    assert list(group.handleInputRows((0,), iter([pd.DataFrame(change[:250]), pd.DataFrame(change[250:] + fact)]), now)) == []
    assert store.calls <= 5 and store.timers == [2 * 20_000]
    assert [len(value[0]) for value in store.values.values()] == [500, 100]
    # 31 of the facts are out at second 50; the versions have not changed and are not written again
    versions, store.calls, now.ms = store.values["versions"], 0, 2 * 50_000 + 1
    store.timers.clear()  # Spark takes back a timer that fires
    [out] = group.handleExpiredTimer((0,), now, None)
    assert sorted(zip(out["m0"], out["a0"])) == [(i, f"n{i}") for i in range(31)]
    assert store.calls <= 4 and store.values["versions"] is versions and store.timers == [2 * 51_000]


def test_all_admitted_at_once_gives_the_same(spark, run, facts_of, log_of):
    """The second query lags: it sees changes before the facts that were out before them."""
    facts, changes = random_history(5)
    one, other = run("one"), run("other")
    for r, step in ((one, one.feed), (other, other.admit)):
        step(changes=changes[:4])
        step(*facts[:60])
        step(changes=changes[4:])
        step(*facts[60:])
        r.job.finish(attempts=1)
    assert one.lines() == other.lines() and len(one.lines()) > 10


class Flaky:
    """A target that fails a few times, before or after its write."""

    def __init__(self, table, failures):
        self.table, self.failures = table, list(failures)

    def upsert(self, lines, token):
        kind = self.failures.pop(0) if self.failures else None
        if kind == "before":
            raise RuntimeError("unreachable")
        written = self.table.upsert(lines, token)
        if kind == "after":
            raise RuntimeError("connection lost")
        return written


def test_outage_restart_and_cold_run(spark, tmp_path, facts_of, log_of):
    facts, changes = random_history(7)
    table = KeyedTable(spark, f"{tmp_path}/target", KEYS)
    log_of(*changes).write.parquet(f"{tmp_path}/changes")

    def job(name, target):
        clock = iter(range(0, 10_000, 10))
        return Consolidation(spark, f"{tmp_path}/checkpoint-{name}", target, clock=lambda: float(next(clock)))

    def catch_up(c):
        # stopped between the waves; each start goes on from the checkpoint
        c.catch_up(spark.readStream.schema(FACTS).parquet(f"{tmp_path}/facts"), spark.readStream.schema(CHANGES).parquet(f"{tmp_path}/changes"), attempts=4, delay=0)

    first = job("first", Flaky(table, ["before", "after", "after"]))
    for a, b in ((0, 50), (50, 90), (90, 120)):
        facts_of(*facts[a:b]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/facts")
        catch_up(first)
    expected = consolidate(facts_of(*facts), log_of(*changes), flush=False)
    after_outage = table.read().collect()
    assert differences(expected, table.read(), KEYS).collect() == []
    assert len(after_outage) == len({tuple(r[k] for k in KEYS) for r in after_outage})

    # a job object made anew finds its place
    assert job("first", table).progress() == first.progress()

    # fresh checkpoint, same target
    catch_up(job("second", table))
    assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(map(tuple, after_outage), key=repr)


def test_the_inputs_place_and_what_was_admitted_belong_together(spark, tmp_path, facts_of, log_of):
    table = KeyedTable(spark, f"{tmp_path}/t", KEYS)
    log_of((PLATA, "P", "1", "r", s(0), 1)).write.parquet(f"{tmp_path}/c")
    job = Consolidation(spark, f"{tmp_path}/checkpoint", table, emit="eager")

    def admit(place):
        facts_of(fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10))).write.mode("append").parquet(f"{tmp_path}/f")
        rows = job.admission.tagged(spark.readStream.schema(FACTS).parquet(f"{tmp_path}/f"), spark.readStream.schema(CHANGES).parquet(f"{tmp_path}/c"))
        run_with_restarts(lambda: job.admission.start(rows, f"{tmp_path}/{place}", None), attempts=1)

    admit("inputs")
    # facts would be counted twice, or the earlier ones not at all
    with pytest.raises(Exception, match=StateMismatch.__name__):
        admit("other-inputs")


def test_a_checkpoint_is_required(spark):
    assert TRIGGER == "10 seconds"
    with pytest.raises(ValueError, match="checkpoint"):
        Consolidation(spark, "", None)


def test_restarts_give_up_after_the_attempts(spark, tmp_path, facts_of, log_of):
    target = Flaky(KeyedTable(spark, f"{tmp_path}/t", KEYS), ["before"] * 9)
    c = Consolidation(spark, f"{tmp_path}/s", target, emit="eager")
    c.admission.process(c.admission.tagged(facts_of(fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(10))), log_of()), 0)
    starts = []

    def start():
        starts.append(1)
        return c.consolidate(None)

    with pytest.raises(Exception, match="unreachable"):
        run_with_restarts(start, attempts=2, delay=0)
    assert len(starts) == 2
