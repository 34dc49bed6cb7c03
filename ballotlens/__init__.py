"""ballotlens — on-chain governance analytics as Spark DataFrame plans.

Every dataset and KPI is a function ``Tables -> DataFrame`` that computes
all epochs in one distributed job. See README.md for the layout.
"""

from ballotlens.session import build_session, ensure_session  # noqa: F401
