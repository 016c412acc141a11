"""Column-expression helpers. Everything here returns ``Column`` objects built
from ``pyspark.sql.functions`` so it stays JVM-side and inside codegen."""
