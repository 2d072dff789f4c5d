"""The scalar rules as columns; an argument is a column name or any other SQL text.

They are built-in expressions, so they stay inside codegen.
"""

from pyspark.sql import functions as F

from tarmac.functions import rules


def time_slot(hhmm):
    return F.expr(rules.time_slot(hhmm))


def slot_from_ordinal(ordinal):
    return F.expr(rules.slot_from_ordinal(ordinal))


def slot_ordinal(slot):
    return F.expr(rules.slot_ordinal(slot))


def delay_label(arrival_delay):
    """The label as a double, as models take it."""
    return F.expr(rules.delay_label(arrival_delay)).cast("double")


def latitude_area(latitude):
    return F.expr(rules.latitude_area(latitude))


def longitude_area(longitude):
    return F.expr(rules.longitude_area(longitude))


def double_or_default(text):
    return F.expr(rules.double_or_default(text))


def strict_double(text):
    return F.expr(rules.strict_double(text))


def strict_int(text):
    return F.expr(rules.strict_int(text))


def int_to_double(number):
    return F.expr(rules.int_to_double(number))
