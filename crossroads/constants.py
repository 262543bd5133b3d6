"""Fixed values of the junction domain.

Everything here is data that results depend on (layouts, thresholds, word lists,
message formats), kept in one place and in plain text.
"""

# --- fixed values: geometry -------------------------------------------------
DIRECTIONS = ["north", "east", "south", "west"]  # clockwise; index = direction code

# eight-lane layout: direction -> lane -> reachable destinations, in order
LAYOUT_EIGHT_LANE = {
    "north": {1: ["F", "H"], 2: ["E", "D", "C"]},
    "east": {3: ["H", "B"], 4: ["G", "E", "F"]},
    "south": {5: ["B", "D"], 6: ["A", "G", "H"]},
    "west": {7: ["D", "F"], 8: ["B", "C", "A"]},
}

# a second layout for the same lanes: straight and right change places, the first left turn also leaves the odd lane
LAYOUT_SECOND = {
    direction: {
        lane: reach[::-1] + lanes[lane + 1][:1] if lane % 2 else reach[1:][::-1] for lane, reach in lanes.items()
    } for direction, lanes in LAYOUT_EIGHT_LANE.items()
}

# two-lane layout: direction -> destinations
LAYOUT_TWO_LANE = {
    "north": ["A", "B"],
    "south": ["C", "D"],
    "east": ["E", "F"],
    "west": ["G", "H"],
}
LANES_PER_DIRECTION = 2
LAYOUT_REQUIRED_KEYS = ["incoming_directions", "lanes_per_direction", "destinations"]

# --- fixed values: rules ----------------------------------------------------
NEAR_DISTANCE_M = 80.0  # near rule: both within this distance
ARRIVAL_GAP_S = 4.0  # lane rule: arrivals at most this far apart
SAME_TIME_S = 1.0  # lane rule: up to here movement decides, beyond it arrival order
CLEARING_S = 2  # seconds one vehicle needs to clear the junction

# --- fixed values: request contract ----------------------------------------
MIN_VEHICLES, MAX_VEHICLES = 2, 20
LANE_RANGE = (1, 10)
SPEED_RANGE = (0.0, 200.0)
DISTANCE_RANGE = (0.0, 2000.0)

# --- fixed values: feature columns -----------------------------------------
DROPPED_COLUMNS = [
    "vehicle_id", "destination", "decisions", "places_of_conflicts", "conflict_vehicles",
    "priority_order", "waiting_times", "scenario_id", "is_conflict",
]
NUMERIC_FEATURES = [
    "lane", "speed", "distance_to_intersection", "direction_enc", "vehicle_waiting_time",
    "vehicle_priority", "avg_speed_in_scenario", "max_speed_in_scenario",
    "num_vehicles_in_scenario", "avg_distance_in_scenario", "number_of_conflicts",
]
MISSING_PRIORITY = 99
FEATURE_TTL_DAYS = 7

# --- fixed values: perturbations -------------------------------------------
SPEED_DELTAS = [-40, -20, -10, -5, -2, 2, 5, 10, 20, 40]
DISTANCE_DELTAS = [-100, -50, -25, -10, -5, 5, 10, 25, 50, 100]
PERTURBED_FLOOR = 5.0
DESTINATION_VARIANTS = 3
SPEED_TABLE_DELTAS = [2, 5, 10, 20, 40]
PERTURBED_FEATURES = ["speed", "distance", "lane", "destination", "vehicle_order"]

# --- fixed values: thresholds of audits and monitoring ----------------------
BIAS_MAX_GAP = 0.15
FNR_MAX = 0.08
RECALL_MIN = 0.92
JSON_FAILURE_MAX = 0.02
RULE_AGREEMENT_MIN = 0.75
ROBUSTNESS_MIN = 0.90
DRIFT_P_VALUE = 0.05
DRIFT_SHARE_MAX = 0.2
WINDOW_SIZE = 100
BALANCE_MIN = 0.40
TRAINING_SEEDS = [42, 123]
REQUIRED_REPLY_KEYS = ["is_conflict", "decisions", "priority_order", "waiting_times"]

# --- fixed values: bands, right-closed: (above, up to, name) -----------------
SPEED_BANDS = [(0, 40, "slow (<40)"), (40, 70, "medium (40-70)"), (70, 9999, "fast (>70)")]
DISTANCE_BANDS = [(0, 50, "near (<50m)"), (50, 150, "mid (50-150m)"), (150, 99999, "far (>150m)")]
SMALL_UP_TO = 4
SIZE_NAMES = ("small (2-4)", "large (5-8)")
DENSITY_NAMES = ("no conflict", "single", "multi (2+)")
PARITY_NAMES = ("left-turn", "straight")  # even lanes, odd lanes

# --- fixed values: sentence formats -------------------------------------------
YIELD_TEXT = "Potential conflict: Vehicle {loser} must yield to Vehicle {winner}"
SCENARIO_SENTENCE = (
    "Vehicle {vehicle_id} is in lane {lane}, moving {direction} at a speed of {speed} km/h, "
    "and is {distance} meters away from the intersection, heading towards {destination}."
)
REPORT_SENTENCE = (
    "Vehicle {vehicle_id} is in lane {lane}, approaching from the {direction}, traveling at {speed} km/h, "
    "and is {distance} meters away from the intersection, heading towards {destination}."
)
ARRIVAL_SENTENCE = (
    "Vehicle {vehicle_id}: lane={lane}, dir={direction}, dest={destination}, "
    "speed={speed}km/h, dist={distance}m, ETA={eta}s"
)
ANALYSIS = {
    "none": "No conflict detected.",
    "found": "Conflict detected.",
    "count": "Number of conflicts: {n}",
    "pair": "Vehicle {first} and Vehicle {second}",
    "involved": "Involved vehicles: {pairs}.",
    "no_pairs": "No vehicles involved in conflicts.",
    "actions": "Actions & Decisions:",
    "no_actions": "No decisions made.",
    "ranks": "Priority Order:",
    "rank": "Vehicle {vehicle_id}: Priority {value}",
    "no_ranks": "No priority information available.",
    "waits": "Waiting Times:",
    "wait": "Vehicle {vehicle_id}: {value} second(s)",
    "no_waits": "No waiting times recorded.",
}
TRIGGER_TEXT = {
    "fnr": "FNR={value} > threshold {limit} (safety-critical)",
    "recall": "Recall={value} < threshold {limit}",
    "json_failure_rate": "JSON failure rate={value} > threshold {limit}",
    "rule_agreement_rate": "Rule agreement={value} < threshold {limit}",
    "drift": "Data drift detected in input features",
    "fine": "All metrics within thresholds",
    "empty": "No predictions logged yet",
}

# --- fixed values: chat record texts ----------------------------------------
CHAT_QUESTION = (
    "Analyze the following scenario and determine if there is a conflict "
    "(Respond only with 'yes' or 'no'): "
)
