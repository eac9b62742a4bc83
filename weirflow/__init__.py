"""weirflow: an event-to-lake pipeline made of Spark DataFrame transformations.

Messages come in as *envelopes* (topic, partition, offset, key, value, ...), are parsed against a
declared schema, checked by rules, enriched, and written to partitioned lake tables; whatever is
rejected goes to a dead-letter table with the rule that failed.  Every operator is a function
``DataFrame -> DataFrame`` (or ``-> Column``), works the same in batch and in Structured Streaming,
and takes its "now" as the parameter ``as_of``.
"""

__version__ = "0.1.0"
