"""From a suite of rules to Spark plans and their results."""
