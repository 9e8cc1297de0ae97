"""``TreeFit.java`` on a session: compiled on the driver by the compiler that Spark brings along, sent to the executors as a jar, once a session."""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T
from pyspark.sql.classic.column import _to_java_column, _to_seq

from cardlens.session import is_local_master

SOURCE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "TreeFit.java")
_ONE = threading.Lock()


def _loader(spark: SparkSession):
    """The driver's class loader of the kernel."""
    sc = spark.sparkContext
    with _ONE:
        if getattr(sc, "_cardlens_kernel", None) is None:
            compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
            with open(SOURCE) as f:
                compiler.cook(f.read())
            code = compiler.getBytecodes()
            jar = os.path.join(tempfile.mkdtemp(prefix="cardlens-code-"), "cardlens_trees.jar")
            with zipfile.ZipFile(jar, "w") as z:
                for name in sorted(code):
                    z.writestr(f"{name.replace('.', '/')}.class", bytes(code[name]))
            sc._jsc.addJar(jar)
            sc._cardlens_kernel = compiler.getClassLoader()
    return sc._cardlens_kernel


def executor_cores(spark: SparkSession) -> int:
    """Cores of a JVM that runs tasks."""
    sc = spark.sparkContext
    if is_local_master(sc.master):
        return sc.defaultParallelism
    return int(sc.getConf().get("spark.executor.cores", "1"))


def executor_heap(spark: SparkSession) -> int:
    """Bytes of heap of a JVM that runs tasks."""
    sc = spark.sparkContext
    if is_local_master(sc.master):
        return sc._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return sc._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(sc.getConf().get("spark.executor.memory", "1g"))


def fit_function(spark: SparkSession, files: list[str], n_rows: int, sizes: np.ndarray, missing: np.ndarray, cuts: list[np.ndarray], scale: float, returns: str):
    """A function of a binary column (``specs``) that gives the fitted trees' rows, an array of ``returns``."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    header = np.concatenate([[executor_cores(spark), n_rows, len(cuts), scale], sizes, missing, [len(c) for c in cuts], *cuts]).astype("<f8")
    conf = jvm.org.apache.spark.util.SerializableConfiguration(spark._jsparkSession.sessionState().newHadoopConf())
    names = jvm.java.util.ArrayList()
    for f in sorted(files):
        names.add(f)
    args = gateway.new_array(jvm.Object, 3)
    args[0], args[1], args[2] = names, conf, bytearray(header.tobytes())
    kernel = _loader(spark).loadClass("cardlens.TreeFit").getConstructors()[0].newInstance(args)
    schema = T.ArrayType(T._parse_datatype_string(f"struct<{', '.join(x.replace(' ', ':') for x in returns.split(', '))}>"))
    # found by its types: py4j takes the function for untyped Scala
    find, types, given = jvm.java.lang.Class.forName, gateway.new_array(jvm.Class, 2), gateway.new_array(jvm.Object, 2)
    types[0], types[1] = find("org.apache.spark.sql.api.java.UDF1"), find("org.apache.spark.sql.types.DataType")
    given[0], given[1] = kernel, spark._jsparkSession.parseDataType(schema.json())
    function = find("org.apache.spark.sql.functions").getMethod("udf", types).invoke(None, given)
    return lambda column: Column(function.apply(_to_seq(spark.sparkContext, [column], _to_java_column)))


def spec(models: list[tuple]) -> bytes:
    """(number, settings) of models that differ in their least child weight only, as the kernel reads them."""
    out = b""
    for i, m in models:
        numbers = [i, m.rounds, m.depth, m.seed, m.logistic, -1 if m.fold_of is None else m.fold_of, -1 if m.fold is None else m.fold, -1 if m.patience is None else m.patience]
        shares = [m.step, m.gamma, m.alpha, m.reg_lambda, m.min_child_weight, m.subsample, m.colsample]
        out += np.array(numbers, "<i8").tobytes() + np.array(shares, "<f8").tobytes()
    return out
