"""Language-model data tables on Spark: corpus packing, tensor tables, submission ledgers and routing analytics."""
