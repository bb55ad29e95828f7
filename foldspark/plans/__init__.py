"""Analysis tables, workflows and the registered queries."""
