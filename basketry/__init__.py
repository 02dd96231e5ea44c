"""Customer-behaviour analytics on retail invoice lines, written as Spark DataFrame jobs."""
