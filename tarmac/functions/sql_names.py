"""The scalar rules as SQL functions, for queries written as SQL text."""

from tarmac.functions import rules

# The function names SQL texts call. Labels and areas are texts there.
_FUNCTIONS = {
    "extractTimeSlot(hhmm STRING) RETURNS STRING": rules.time_slot("hhmm"),
    "extractDelayLabel(delay INT) RETURNS STRING": f"string({rules.delay_label('delay')})",
    "extractLatitudeArea(latitude DOUBLE) RETURNS STRING": (
        f"string({rules.latitude_area('latitude')})"
    ),
    "extractLongitudeArea(longitude DOUBLE) RETURNS STRING": (
        f"string({rules.longitude_area('longitude')})"
    ),
    "stringToInt(s STRING) RETURNS INT": rules.strict_int("s"),
    "intToDouble(i INT) RETURNS DOUBLE": rules.int_to_double("i"),
}
_TO_DOUBLE = (
    f"CASE WHEN strict THEN {rules.strict_double('s')} ELSE {rules.double_or_default('s')} END"
)


def register_sql_functions(spark, strict_double=False):
    """Register the named functions in the session.

    ``stringToDouble(text, strict)`` has two meanings: it turns bad text into the
    missing-coordinate value or, if strict, fails. ``strict_double`` says which one a call
    without the second argument gets.
    """
    number = f"stringToDouble(s STRING, strict BOOLEAN DEFAULT {strict_double}) RETURNS DOUBLE"
    for signature, body in {**_FUNCTIONS, number: _TO_DOUBLE}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
