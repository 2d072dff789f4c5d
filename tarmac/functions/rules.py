"""The scalar rules as SQL text: each takes SQL texts and returns one, so rules can be nested.

Columns (``scalars``) and SQL functions (``sql_names``) are both made from these texts.
"""

from tarmac.constants import MISSING_COORDINATE, TIME_SLOTS

MORNING, AFTERNOON, EVENING, NIGHT = TIME_SLOTS


def time_slot(hhmm):
    """Slot of an ``hhmm`` departure text; a text without an hour fails the job.

    Every hour outside 0-17 is Evening, also 24 and negative ones. Few, ordered tests, as each
    one parses the hour again. Declared as never null, or joins and filters on the slot would
    work it out twice.
    """
    head = f"substring({hhmm}, 1, 2)"
    hour = f"try_cast({head} AS INT)"
    no_hour = f"raise_error(concat('no hour in departure time: ', coalesce({hhmm}, 'null')))"
    return f"""coalesce(
        CASE WHEN length(trim({head})) <> 2 THEN {no_hour}
             WHEN {hour} > 17 THEN '{EVENING}'
             WHEN {hour} > 11 THEN '{AFTERNOON}'
             WHEN {hour} > 5 THEN '{MORNING}'
             WHEN {hour} >= 0 THEN '{NIGHT}'
             WHEN {hour} < 0 THEN '{EVENING}'
             ELSE {no_hour} END, '{EVENING}')"""


def slot_from_ordinal(ordinal):
    """Slot name of ordinal 0..3; any other ordinal fails the job."""
    names = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(TIME_SLOTS))
    text = f"coalesce(cast({ordinal} AS STRING), 'null')"
    return f"CASE {ordinal} {names} ELSE raise_error('no time slot with ordinal ' || {text}) END"


def slot_ordinal(slot):
    """Ordinal 0..3 of a slot name, null for any other text."""
    names = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(TIME_SLOTS))
    return f"CASE {slot} {names} END"


def delay_label(arrival_delay):
    """1 for a late arrival, 0 for one on time or early, null when unknown."""
    return f"CASE WHEN {arrival_delay} > 0 THEN 1 WHEN {arrival_delay} IS NOT NULL THEN 0 END"


def latitude_area(latitude):
    """0 south of -30, else 3: the two areas the thresholds can reach."""
    return f"CASE WHEN {latitude} < -30 THEN 0 ELSE 3 END"


def longitude_area(longitude):
    return (
        f"CASE WHEN {longitude} < -130 THEN 0 WHEN {longitude} < -110 THEN 1 "
        f"WHEN {longitude} < -90 THEN 2 ELSE 3 END"
    )


def double_or_default(text, default=MISSING_COORDINATE):
    return f"coalesce(try_cast({text} AS DOUBLE), double({default}))"


def strict_double(text):
    """Number in the text; null stays null, malformed text fails under ANSI mode."""
    return f"cast({text} AS DOUBLE)"


def strict_int(text):
    return f"cast({text} AS INT)"


def int_to_double(number):
    return f"cast({number} AS DOUBLE)"
