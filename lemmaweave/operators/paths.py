"""Shortest paths from many sources over one edge list, as a function in the JVM.

The walk goes from edge to edge, which steps over arrays do several times as slowly. It
is compiled by the compiler that Spark itself uses for its plans, so nothing need be
installed; its class goes to the executors as an archive, as the package does.
"""

from __future__ import annotations

import io
import uuid
import zipfile

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lemmaweave.sources import shared_file

_NAME = "LemmaweaveBetween"
# Nodes come numbered by falling in-degree and lists are sorted, so the targets below the
# first node unseen when a level begins, the hubs above all, need no look at their level.
_SOURCE = f"""
public class {_NAME} implements org.apache.spark.sql.api.java.UDF4 {{
    public Object call(Object edges, Object nodes, Object first, Object step) {{
        scala.collection.Iterator each = ((scala.collection.Iterable) edges).iterator();
        int m = ((scala.collection.Iterable) edges).size(), n = ((Number) nodes).intValue();
        long[] pairs = new long[m];
        for (int i = 0; i < m; i++) pairs[i] = ((Number) each.next()).longValue();
        java.util.Arrays.sort(pairs);
        int[] start = new int[n + 1], out = new int[m];
        for (int i = 0; i < m; i++) {{ start[(int) (pairs[i] >>> 32) + 1]++; out[i] = (int) pairs[i]; }}
        for (int v = 0; v < n; v++) start[v + 1] += start[v];
        pairs = null;
        double[] total = new double[n];
        walk(n, start, out, ((Number) first).intValue(), ((Number) step).intValue(), total);
        return total;
    }}

    static void walk(int n, int[] start, int[] out, int first, int step, double[] total) {{
        byte[] state = new byte[n];
        int[] queue = new int[n], upto = new int[n], down = new int[out.length];
        double[] paths = new double[n], part = new double[n];
        for (long s = first; s < n; s += step) {{
            one((int) s, n, start, out, state, queue, upto, down, paths, part, total);
        }}
    }}

    static void one(int s, int n, int[] start, int[] out, byte[] state, int[] queue, int[] upto, int[] down, double[] paths, double[] part, double[] total) {{
        int kept = 0, tail = 1, seen = 0, head = 0;
        queue[0] = s; state[s] = 2; paths[s] = 1;
        // State: 0 not met, 1 met in the level that is being made, 2 met before.
        while (head < tail) {{
            int end = tail;
            while (seen < n && state[seen] == 2) seen++;
            for (; head < end; head++) {{
                int v = queue[head];
                double ways = paths[v];
                for (int e = start[v], last = start[v + 1]; e < last; e++) {{
                    int w = out[e];
                    if (w < seen) continue;
                    int known = state[w];
                    if (known == 2) continue;
                    if (known == 0) {{ state[w] = 1; queue[tail++] = w; }}
                    paths[w] += ways; down[kept++] = w;
                }}
                upto[head] = kept;
            }}
            // A large level is put in the order of the nodes, so lists are read as they lie.
            if (tail - end > n / 32) {{
                int at = end;
                for (int w = 0; w < n; w++) if (state[w] == 1) queue[at++] = w;
            }}
            for (int at = end; at < tail; at++) state[queue[at]] = 2;
        }}
        // Backwards: part is (1 + share) / paths of a node, share what it adds to its total.
        for (int at = tail - 1; at >= 0; at--) {{
            int v = queue[at];
            double sum = 0;
            for (int e = at > 0 ? upto[at - 1] : 0; e < upto[at]; e++) sum += part[down[e]];
            part[v] = 1 / paths[v] + sum;
            if (at > 0) total[v] += paths[v] * sum;
        }}
        for (int at = 0; at < tail; at++) {{ state[queue[at]] = 0; paths[queue[at]] = 0; }}
    }}
}}
"""
_FUNCTION = "lemmaweave_between"
_KNOWN: set[str] = set()


def between(spark: SparkSession, edges: str, nodes: str, first: str, step: str) -> Column:
    """Per node from 0 to ``nodes`` - 1 the shares of the shortest paths that lead through
    it, from every ``step``-th source on from ``first``; an edge is source * 2^32 + target.
    """
    return F.call_function(_function(spark), edges, nodes, first, step)


def _function(spark: SparkSession) -> str:
    """The name of the function in this session, made once."""
    assert spark._jvm is not None
    session = str(spark._jsparkSession.sessionUUID())
    if session not in _KNOWN:
        compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(_SOURCE)
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, code in compiler.getBytecodes().items():
                archive.writestr(f"{name.replace('.', '/')}.class", bytes(code))
        spark.sparkContext._jsc.addJar(shared_file(spark, f"{_NAME}-{uuid.uuid4().hex}.jar", data.getvalue()))
        kind = spark._jvm.org.apache.spark.sql.types.DataType.fromDDL("array<double>")
        walk = compiler.getClassLoader().loadClass(_NAME).getConstructors()[0].newInstance(None)
        spark._jsparkSession.udf().register(_FUNCTION, walk, kind)
        _KNOWN.add(session)
    return _FUNCTION
