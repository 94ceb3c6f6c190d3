import re

import pytest

from tidelog.llm.scratch import Scratch


def kept_back(spark):
    """MB of freed native memory that the JVM still held, by its own word; it gives them back."""
    jvm = spark._jvm
    call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
    args = spark.sparkContext._gateway.new_array(jvm.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    said = re.search(r"\(([+-]\d+)([BKMG])\)", call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args))
    if said is None:
        pytest.skip("this JVM does not tell")
    return -int(said[1]) * {"B": 1e-6, "K": 1e-3, "M": 1, "G": 1e3}[said[2]]


def fill_and_free(spark):
    packers = [spark._jvm.java.util.zip.Deflater() for _ in range(1500)]
    for i, x in enumerate(packers):
        if i % 20:
            x.end()  # what stays keeps the C library from giving the rest back by itself
    return packers[::20]


def test_the_driver_hands_freed_native_memory_back(spark):
    kept_back(spark)
    held = fill_and_free(spark)
    least = kept_back(spark)
    held += fill_and_free(spark)
    out = Scratch(spark).save(spark.range(3), "table")
    assert least > 100 and kept_back(spark) < least / 3
    assert out.count() == 3
    for x in held:
        x.end()
