"""mixprep: instruction-data preparation as Spark DataFrame operators.

Every operator is either a ``Column`` expression (``mixprep.functions``) or a
``DataFrame -> DataFrame`` transformation (``mixprep.operators``); sources and
sinks live in ``mixprep.sources`` / ``mixprep.sinks`` and user-level pipelines in
``mixprep.plans``. Nothing in the library collects rows to the driver.
"""

__version__ = "0.1.0"
