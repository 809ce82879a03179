"""The change detector's state: many contents under one key, few calls, and each content forgotten on its own."""

from types import SimpleNamespace

from pyspark.sql import Row

from paperloom.streaming import incremental as I


class State:
    """One key's state and timers; counts the calls."""

    def __init__(self):
        self.calls, self.rows, self.timers = 0, [], set()

    def getListState(self, name, schema):
        return self

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return bool(self.rows)

    def update(self, value):
        self.calls += 1
        self.rows = [value]

    def get(self):
        self.calls += 1
        return iter(list(self.rows))

    def put(self, rows):
        self.calls += 1
        self.rows = list(rows)

    def appendValue(self, row):
        self.calls += 1
        self.rows.append(row)

    def clear(self):
        self.calls += 1
        self.rows = []

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def sights(numbers, at=0, seq=0):
    return iter([Row(seq=seq + n, identifier=f"i{n}", file_hash="h", at=at) for n in numbers])


def detector(keep_for=None):
    state, found = State(), I.FirstSeen(keep_for)
    found.init(state)
    return state, found


def test_state_is_asked_once_for_many_contents():
    state, found = detector()
    new = list(found.handleInputRows((7,), sights([*range(1_000), *range(500)]), None))
    assert sorted(r.seq for r in new) == list(range(1_000)) and state.calls <= 4
    new = list(found.handleInputRows((7,), sights(range(990, 1_010), seq=5_000), None))
    assert sorted(r.identifier for r in new) == [f"i{n}" for n in range(1_000, 1_010)] and state.calls <= 8


def test_earliest_row_counts_and_blocks_are_merged():
    state, found = detector()
    rows = [Row(seq=s, identifier=i, file_hash="h", at=0) for s, i in [(5, "a"), (2, "a"), (9, None), (3, "-")]]
    assert sorted(r.seq for r in found.handleInputRows((0,), iter(rows), None)) == [2, 3, 9]
    for n in range(3 * I.BLOCKS):
        assert len(list(found.handleInputRows((0,), sights([n]), None))) == 1
    assert len(state.rows) <= I.BLOCKS and list(found.handleInputRows((0,), sights(range(3 * I.BLOCKS)), None)) == []


def test_contents_are_forgotten_one_by_one():
    state, found = detector(keep_for=10)
    list(found.handleInputRows((1,), sights([1, 2], at=100), None))
    list(found.handleInputRows((1,), sights([2], at=105), None))
    assert state.timers == {110}
    list(found.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 112), None))
    state.timers.discard(110)
    assert state.timers == {115}
    assert [r.identifier for r in found.handleInputRows((1,), sights([1, 2], at=112), None)] == ["i1"]
