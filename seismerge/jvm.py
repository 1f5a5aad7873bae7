"""Row functions in Java for steps that no plan of native operators can state
and that would take one Python worker too long.

The source is compiled by Janino, the compiler that Spark's own code generation
uses, once per application. Executors get the classes as a jar, as they would
get any other one.
"""

from __future__ import annotations

import os
import pkgutil
import tempfile
import threading
import zipfile

from pyspark.sql import DataFrame, SparkSession, types as T

_LOCK = threading.Lock()
_LOADED: dict[tuple[str, str], object] = {}


def _class(spark: SparkSession, name: str):
    """The class of ``operators/<name>.java``, known to the executors."""
    key = spark.sparkContext.applicationId, name
    with _LOCK:
        if key not in _LOADED:
            compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
            compiler.setParentClassLoader(spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
            compiler.cook(pkgutil.get_data("seismerge.operators", f"{name}.java").decode())
            jar = os.path.join(tempfile.mkdtemp(prefix="seismerge-jar-"), f"{name}.jar")
            with zipfile.ZipFile(jar, "w") as z:
                for entry, code in compiler.getBytecodes().items():
                    z.writestr(entry.replace(".", "/") + ".class", bytes(code))
            spark._jsc.sc().addJar(jar)
            _LOADED[key] = compiler.getClassLoader().loadClass(f"seismerge.{name}")
        return _LOADED[key]


def map_partitions(df: DataFrame, name: str, schema: T.StructType, *args) -> DataFrame:
    """``df``'s partitions through a new ``name(*args)``, which gives rows of ``schema``."""
    spark = df.sparkSession
    values = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Object, len(args))
    for k, value in enumerate(args):
        values[k] = value
    function = _class(spark, name).getConstructors()[0].newInstance(values)
    encoder = spark._jvm.org.apache.spark.sql.Encoders.row(spark._jsparkSession.parseDataType(schema.json()))
    return DataFrame(df._jdf.mapPartitions(function, encoder), spark)
