"""tagloom: audit-event analytics as Spark DataFrame operators.

Detail rows arrive as tag/value pairs, are cleaned and woven into columns by a
rule table, joined to the main request log, and given customer, channel, event
and error keys.  Every public function takes and returns a DataFrame or a
Column, uses no global session and leaves the physical plan to Spark.
"""

from tagloom.plans.audit import audit_flow

__all__ = ["audit_flow"]
