"""Run parameters of the registered queries.

The reference runs daily with the run date ``ds``. The stand-in fixtures
(FIXTURES.md) hold rows for these dates, so the registered queries use
them; every operator takes ``ds`` as an argument.
"""

# Run date of the E views and reports (the label only, no filter).
RUN_DS = "2024-01-01"
# Snapshot date of staff and coverage rows.
SNAPSHOT_DS = "2024-01-01"
# Prediction date that selects rows of the predictions fixture.
PREDICTION_DS = "1998-01-01"
# Run date whose month (``ds[:7]``) selects transport rows.
TRANSPORT_DS = "1998-03-15"
# Revenue and cost per delivery (random draws in the reference).
REVENUE_PER_DELIVERY = 65.0
COST_PER_DELIVERY = 35.0
