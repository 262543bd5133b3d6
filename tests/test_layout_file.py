"""Rules and what-if under a layout read from a file, against loops that know the same layout."""

import json

import pytest

import brute
from crossroads import constants as C
from crossroads.operators import cascade, lane, perturb
from crossroads.sources import readers
from test_what_if import DATA, expected, got, label

OTHER = {
    "north": {1: ["E", "D", "F"], 2: ["H", "C"]}, "east": {3: ["G"], 4: ["B", "H", "E"]},
    "south": {5: ["G", "H", "A"], 6: ["B", "D"]}, "west": {7: ["C", "A"], 8: ["F", "D", "B"], 9: ["A", "D"]},
}


@pytest.fixture
def layout(spark, tmp_path, monkeypatch):
    path = tmp_path / "layout.json"
    path.write_text(json.dumps({"intersection_layout": {d: {str(n): r for n, r in lanes.items()} for d, lanes in OTHER.items()}}))
    monkeypatch.setattr(brute, "REACH", {(d, n): "".join(r) for d, lanes in OTHER.items() for n, r in lanes.items()})
    monkeypatch.setattr(brute, "movement", lambda v: None if v[6] not in (r := brute.REACH.get((v[5], v[2]), "")) else (
        "left" if v[2] % 2 == 0 else ["right", "straight", "left"][r.index(v[6])]))
    return readers.layout_row(readers.lane_layout(spark, str(path)))


def test_one_value_holds_the_layout(layout):
    assert layout.collect()[0].layout == OTHER


def test_pairs_labels_and_queues_follow_the_layout(rows, layout):
    groups = brute.by_scenario(DATA)
    want = sorted((sid, p[0], p[1]) for sid, vs in groups.items() for p in brute.lane_pairs(vs))
    assert want
    at = lambda df: sorted((r.scenario_id, r.seq1, r.seq2) for r in df.collect())
    assert at(lane.pairs(lane.packed(rows(DATA), layout))) == at(lane.all_pairs(rows(DATA), layout)) == want
    assert at(lane.pairs(lane.packed(rows(DATA)))) != want
    labels = {sid: label(vs) for sid, vs in groups.items()}
    assert {r.scenario_id: r.is_conflict for r in lane.labels_of_rows(rows(DATA), layout).collect()} == labels
    assert {r.scenario_id: r.is_conflict for r in lane.decisions_of_rows(rows(DATA), layout=layout).collect()} == labels
    ranked = {(r.scenario_id, r.seq) for r in cascade.waits_of_rows(rows(DATA), layout).collect() if r.rank}
    assert ranked == {(sid, q) for sid, a, b in want for q in (a, b)}


@pytest.mark.parametrize("feature", ["speed", "lane", "destination"])
def test_copies_follow_the_layout(rows, layout, feature):
    s = lane.packed(rows(DATA), layout)
    want = expected(feature)
    assert got(perturb.records(s, feature, layout=layout)) == want
    fast = perturb.lane_records(s, feature) if feature == "speed" else perturb.single_vehicle_records(s, [feature], layout=layout)
    assert got(fast) == want


def test_a_dict_and_a_file_give_the_same(rows, layout):
    read, given = lane.prepared(rows(DATA), layout), lane.prepared(rows(DATA), OTHER)
    assert sorted(read.collect()) == sorted(given.collect()) != sorted(lane.prepared(rows(DATA)).collect())


def test_what_a_layout_does_not_know_is_unknown(spark, rows):
    odd = [(1, 1, 1, 50, 40, "up", "F"), (1, 2, 99, 50, 40, "north", "F"), (1, 3, None, 50, 40, None, None), (1, 4, 1, 50, 40, "north", "F")]
    of = lambda layout: [r.m for r in lane.prepared(rows(odd), layout).orderBy("seq").collect()]
    assert of(C.LAYOUT_EIGHT_LANE) == ["unknown", "unknown", "unknown", "right"]
    empty = readers.layout_row(readers.lane_layout(spark).limit(0))
    assert empty.count() == 1 and of(empty) == ["unknown"] * 4
    assert perturb.all_records(lane.packed(rows(odd[:2] + odd[3:])), C.LAYOUT_EIGHT_LANE).count() > 0


def test_both_order_forms_agree(rows):
    s = lane.packed(rows(DATA + [(900, 1, 1, 50, 40, "north", "F")]))
    whole = lambda df: sorted(map(tuple, df.collect()))
    assert whole(perturb.order_records(s)) == whole(perturb.records(s, "vehicle_order"))
    always = perturb.order_records(s, shuffles=4, always_reverse=True)
    assert always.filter("delta = 'reverse'").count() == len(brute.by_scenario(DATA)) + 1
