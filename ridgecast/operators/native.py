"""The kernel's inner loop inside the JVM, for terrain given by formulas: links of packed rows without a step through Python.

``SOURCE`` is compiled by Janino, the compiler of Spark's own generated code, and sent to executors as a jar. It is the construction of ``kernel.edges``, sample by sample
in the same order of steps; ``blocks`` runs that numpy form for every other terrain.
"""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame

from ridgecast.config import Radio
from ridgecast.operators import kernel

SOURCE = r"""
package ridgecast;

import java.util.Iterator;
import java.util.List;
import org.apache.spark.sql.Row;
import org.apache.spark.sql.RowFactory;

/* The loops over samples, in blocks of eight. */
public class Loops {
    private double[] column = new double[0], line = column;

    /* The largest, or minus infinity. */
    static double peak(double[] v, int first, int last) {
        double a = Double.NEGATIVE_INFINITY, b = a;
        for (int i = first; i < last; i += 2) {
            if (v[i] > a) a = v[i];
            if (v[i + 1] > b) b = v[i + 1];
        }
        return b > a ? b : a;
    }

    /* Columns (or rows, sign -1) of samples. */
    private static void places(double[] f, double d, double from, double origin, double cell, double sign, double[] out, int first, int last) {
        for (int i = first; i < last; i++) out[i] = Math.rint(sign * ((d * f[i] + from) - origin) / cell);
    }

    private static void heights(double[] c, double[] r, double[] square, double curve, double[] e, int first, int last) {
        for (int i = first; i < last; i++) {
            double t = c[i] * 7.0 + r[i] * 3.0;
            e[i] = (300.0 - Math.abs(t - Math.rint(t * (1.0 / 200.0)) * 200.0)) - curve * square[i];
        }
    }

    private static void above(double[] f, double[] weight, double[] e, double[] v, int first, int last, double a, double b) {
        for (int i = first; i < last; i++) v[i] = (e[i] - (b * f[i] + a)) * weight[i];
    }

    /* Bent ground at samples of a way inside the raster (e), how far it rises over the line of a + b * f, by weight (v), and the most of that. */
    public double rise(double[] f, double[] square, double[] weight, double[] e, double[] v, int first, int last, double dx, double x, double x0, double dy, double y, double y0, double cell, double curve, double a, double b) {
        if (column.length < f.length) { column = new double[f.length]; line = new double[f.length]; }
        places(f, dx, x, x0, cell, 1.0, column, first, last);
        places(f, dy, y, y0, cell, -1.0, line, first, last);
        heights(column, line, square, curve, e, first, last);
        return over(f, weight, e, v, first, last, a, b);
    }

    /* The most that ground rises over the line of a + b * f, by weight. */
    public double over(double[] f, double[] weight, double[] e, double[] v, int first, int last, double a, double b) {
        above(f, weight, e, v, first, last, a, b);
        return peak(v, first, last);
    }
}

public class Links implements org.apache.spark.api.java.function.MapPartitionsFunction {
    private static final long serialVersionUID = 1L;
    public static final int LINKS = 0, RECEIVERS = 1, TRANSMITTERS = 2, FOOTPRINTS = 3;
    private final int mode, n, most;
    private final String tx, rx, weight, prefix;
    /* frequency, eirp, subcarriers, shadow margin, receiver height, earth's factor, range, floor, threshold, earth, light */
    private final double freq, eirp, subcarriers, shadow, rxHeight, k, radius, floor, threshold, earth, light;
    /* of the terrain */
    private final double x0, y0, cell, rows, cols;
    private transient double[] f, square, whole;
    private transient int[] cuts;
    private transient Loops loops;
    /* A bound on a signal is off by less than this share, which is under 2e-6 dB. */
    static final double SLACK = 1.0 + 2e-7;
    /* A knife edge of v takes more than r decibels where sqrt(w * w + 1) + w, w = v - 0.1, is above 10 ** (r / 20) times this. */
    static final double EDGE = Math.pow(10.0, -6.9 / 20.0);
    private transient double[][] left, right;

    /* most: servers of a receiver are counted up to here, and no links; below 0, all of both. */
    public Links(int mode, String tx, String rx, String weight, String prefix, int samples, int most, List q, List ground) {
        this.mode = mode; this.most = most; this.tx = tx; this.rx = rx; this.weight = weight; this.prefix = prefix; this.n = samples;
        freq = num(q, 0); eirp = num(q, 1); subcarriers = num(q, 2); shadow = num(q, 3); rxHeight = num(q, 4); k = num(q, 5); radius = num(q, 6); floor = num(q, 7); threshold = num(q, 8); earth = num(q, 9); light = num(q, 10);
        x0 = num(ground, 0); y0 = num(ground, 1); cell = num(ground, 2); rows = num(ground, 3); cols = num(ground, 4);
    }

    static double num(List l, int i) { Object o = l.get(i); return o == null ? Double.NaN : ((Number) o).doubleValue(); }

    static double[] numbers(Row row, String name) {
        List l = row.getList(row.fieldIndex(name));
        double[] out = new double[l.size()];
        for (int i = 0; i < out.length; i++) out[i] = num(l, i);
        return out;
    }

    static double bare(double w) { return Double.isNaN(w) || Double.isInfinite(w) ? 0.0 : w; }

    /* As kernel._shares. */
    void shares() {
        int m = (n + 7) / 8 * 8;
        f = new double[m]; square = new double[m]; whole = new double[m]; left = new double[n][m]; right = new double[n][m];
        double step = 1.0 / (n - 1);
        for (int i = 0; i < n; i++) f[i] = i * step;
        for (int i = n - 1; i < m; i++) f[i] = square[i] = 1.0; /* whole blocks; what is beyond the last sample weighs nothing */
        cuts = new int[] {m, (m - m / 4) / 8 * 8, m / 2 / 8 * 8, 0};
        try {
            loops = (Loops) Class.forName("ridgecast.Lanes", true, Links.class.getClassLoader()).getDeclaredConstructor(new Class[0]).newInstance(new Object[0]);
        } catch (Throwable missing) {
            loops = new Loops(); /* this JVM has no module of vectors */
        }
        for (int i = 0; i < n; i++) {
            square[i] = f[i] * f[i];
            whole[i] = bare(1.0 / Math.sqrt(f[i] * (1.0 - f[i])));
        }
        for (int a = 0; a < n; a++)
            for (int i = 1; i < n - 1; i++) {
                double p = f[a], s = f[i];
                if (s < p) left[a][i] = bare(Math.sqrt(p / (s * (p - s))));
                if (s > p) right[a][i] = bare(Math.sqrt((1.0 - p) / ((s - p) * (1.0 - s))));
            }
    }

    static double knife(double v) {
        if (!(v > 0.0)) return 0.0;
        double w = v - 0.1;
        return Math.max(0.0, 6.9 + 20.0 * Math.log10(Math.sqrt(w * w + 1.0) + w));
    }

    static double within(double a, double most) { return a < 0.0 ? 0.0 : a > most ? most : a; }

    static double height(double c, double r) {
        double t = c * 7.0 + r * 3.0;
        return 300.0 - Math.abs(t - Math.rint(t * (1.0 / 200.0)) * 200.0);
    }

    /* Bent ground at samples of a way that leaves the raster, and how far it rises over the line of a + b * f. */
    double riseOutside(double[] e, double[] v, int first, int last, double dx, double x, double dy, double y, double curve, double a, double b) {
        for (int i = first; i < last; i++) {
            e[i] = height(within(Math.rint(((dx * f[i] + x) - x0) / cell), cols - 1.0), within(Math.rint((y0 - (dy * f[i] + y)) / cell), rows - 1.0)) - curve * square[i];
            v[i] = (e[i] - (b * f[i] + a)) * whole[i];
        }
        return Loops.peak(v, first, last);
    }

    Object[] keyOf(Row row) {
        return mode == FOOTPRINTS ? new Object[] {row.getAs("t_gx"), row.getAs("t_gy"), row.getAs("t_no")} : new Object[] {row.getAs("gx"), row.getAs("gy"), row.getAs("r_no")};
    }

    /* The links of a packed row, at the floor or above, by receiver and then by transmitter. Of a mode with a Best they are added to it; once a receiver has enough servers
       to be told, only pairs are looked at that may be stronger than its strongest. */
    final class Unit {
        final Row row;
        final Object[] key;
        final List txIds, rxIds;
        final double[] clutter;
        final double fixed = 20.0 * Math.log10(freq), sent = eirp - 10.0 * Math.log10(subcarriers);
        final double[] e = new double[f.length], v = new double[f.length];
        int size = 0;
        int[] r, t;
        double[] rsrp, path, diff, far;
        boolean[] los;
        /* of the pair that was looked at last */
        double got, free, loss, length;
        boolean blocked;

        Unit(Row row, Object[] key, Best best) {
            this.row = row; this.key = key;
            txIds = row.getList(row.fieldIndex("t_" + tx));
            rxIds = row.getList(row.fieldIndex("r_" + rx));
            clutter = numbers(row, "r___clutter");
            double[] tX = numbers(row, "t_x"), tY = numbers(row, "t_y"), h = numbers(row, "t_tx_height_m"), rX = numbers(row, "r_x"), rY = numbers(row, "r_y");
            if (best == null) {
                int m = 1024;
                r = new int[m]; t = new int[m]; rsrp = new double[m]; path = new double[m]; diff = new double[m]; far = new double[m]; los = new boolean[m];
            }
            boolean[] old = new boolean[tX.length];
            if (best != null) for (int j = 0; j < old.length; j++) old[j] = !String.valueOf(txIds.get(j)).startsWith(prefix);
            boolean bound = best != null && most >= 0;
            for (int i = 0; i < rX.length; i++) {
                double limit = floor, oldLimit = floor, gain = 0.0, oldGain = 0.0, reach = 0.0, oldReach = 0.0;
                boolean changed = true;
                int first = bound ? nearest(tX, tY, rX[i], rY[i]) : -1;
                for (int q = first < 0 ? 0 : -1; q < tX.length; q++) {
                    int j = q < 0 ? first : q;
                    if (q >= 0 && q == first) continue;
                    if (changed) {
                        if (bound) { limit = best.limit(i, best.best[i]); oldLimit = best.limit(i, best.old[i]); }
                        gain = gain(clutter[i], limit);
                        oldGain = oldLimit == limit ? gain : gain(clutter[i], oldLimit);
                        reach = reach(gain); oldReach = reach(oldGain);
                        changed = false;
                    }
                    double dx = rX[i] - tX[j], dy = rY[i] - tY[j], two = dx * dx + dy * dy;
                    if (!(two <= (old[j] ? oldReach : reach))) continue;
                    if (!known(dx, dy, two, tX[j], tY[j], h[j], clutter[i], old[j] ? oldLimit : limit, old[j] ? oldGain : gain) || !(got >= floor)) continue;
                    if (best != null) {
                        changed = best.add(i, txIds.get(j), old[j], got, length, !blocked) && bound;
                        continue;
                    }
                    if (size == r.length) more();
                    r[size] = i; t[size] = j; rsrp[size] = got; path[size] = free + loss + clutter[i]; diff[size] = loss; far[size] = length; los[size] = !blocked;
                    size++;
                }
            }
        }

        int nearest(double[] x, double[] y, double a, double b) {
            int at = -1;
            double least = Double.POSITIVE_INFINITY;
            for (int j = 0; j < x.length; j++) {
                double dx = a - x[j], dy = b - y[j], two = dx * dx + dy * dy;
                if (two < least) { least = two; at = j; }
            }
            return at;
        }

        /* The length in free space at which a signal is down to the limit, and the square of the longest way worth a look. */
        double gain(double clut, double limit) { return Math.pow(10.0, (sent - fixed - 32.44 - clut - shadow - limit) / 20.0 + 3.0); }

        double reach(double gain) {
            double most = gain * SLACK;
            return most < 1.0 ? -1.0 : Math.min(radius * radius, most * most);
        }

        /* Whether the pair's signal was found out; else it is sure to be below the limit. Every loss found only lowers it. */
        boolean known(double dx, double dy, double two, double x, double y, double h, double clut, double limit, double gain) {
            length = Math.sqrt(two);
            double room = gain / Math.max(length, 1.0) * SLACK;
            if (room < 1.0) return false;
            room = room * EDGE;
            double curve = length * length / (2.0 * k * earth), scale = Math.sqrt(2.0 * freq * 1e6 / (light * length));
            double ca = Math.rint(((dx * f[0] + x) - x0) / cell), cb = Math.rint(((dx * f[n - 1] + x) - x0) / cell), ra = Math.rint((y0 - (dy * f[0] + y)) / cell), rb = Math.rint((y0 - (dy * f[n - 1] + y)) / cell);
            double w = cols - 1.0, d = rows - 1.0;
            /* a straight way lies between its ends */
            boolean inside = ca >= 0.0 && ca <= w && cb >= 0.0 && cb <= w && ra >= 0.0 && ra <= d && rb >= 0.0 && rb <= d, real = !Double.isInfinite(scale);
            double zt = height(within(ca, w), within(ra, d)) + h, zr = height(within(cb, w), within(rb, d)) + rxHeight, top = Double.NEGATIVE_INFINITY;
            int from = 0;
            /* the receiver's end first: that is where most of what is too weak is blocked */
            for (int c = 1; c < cuts.length; c++) {
                int first = cuts[c], last = cuts[c - 1];
                double m = inside ? loops.rise(f, square, whole, e, v, first, last, dx, x, x0, dy, y, y0, cell, curve, zt, zr - zt - curve) : riseOutside(e, v, first, last, dx, x, dy, y, curve, zt, zr - zt - curve);
                if (m >= top) {
                    top = m; from = first;
                    double u = top * scale - 0.1;
                    if (top > 0.0 && real && Math.sqrt(u * u + 1.0) + u > room) return false;
                }
            }
            blocked = top > 0.0 && real;
            free = 20.0 * Math.log10(Math.max(length, 1.0) / 1000.0) + fixed + 32.44;
            loss = 0.0;
            double bare = sent - free;
            if (blocked) {
                int at = from;
                while (v[at] != top) at++;
                loss = knife(top * scale);
                if (bare - loss - clut - shadow < limit - 1e-6) return false;
                double p = f[at], zp = e[at] + curve * p * p, slope = (zr - zp) / (1.0 - p);
                /* samples that are not on the side weigh nothing */
                double one = knife(loops.over(f, left[at], e, v, 0, (at + 7) / 8 * 8, zt, (zp - zt) / p - curve * p) * scale);
                if (bare - (loss + one) - clut - shadow < limit - 1e-6) return false;
                loss = loss + (one + knife(loops.over(f, right[at], e, v, at / 8 * 8, f.length, zp - slope * p + curve * p, slope - curve * (1.0 + p)) * scale));
            }
            got = bare - loss - clut - shadow;
            return true;
        }

        void more() {
            int m = 2 * size;
            r = java.util.Arrays.copyOf(r, m); t = java.util.Arrays.copyOf(t, m);
            rsrp = java.util.Arrays.copyOf(rsrp, m); path = java.util.Arrays.copyOf(path, m); diff = java.util.Arrays.copyOf(diff, m); far = java.util.Arrays.copyOf(far, m);
            los = java.util.Arrays.copyOf(los, m);
        }
    }

    /* Of each receiver of a packed row: its strongest link (ties: smallest transmitter), its weakest, counts, and the strongest of older transmitters. */
    final class Best {
        final Object[] key;
        final List ids;
        final double[] best, low, old, far;
        final Object[] server;
        final boolean[] los;
        final long[] links, served;

        Best(Row row, Object[] key) {
            this.key = key; ids = row.getList(row.fieldIndex("r_" + rx));
            int m = ids.size();
            best = new double[m]; low = new double[m]; old = new double[m]; far = new double[m]; server = new Object[m]; los = new boolean[m]; links = new long[m]; served = new long[m];
            java.util.Arrays.fill(best, Double.NEGATIVE_INFINITY);
            java.util.Arrays.fill(old, Double.NEGATIVE_INFINITY);
            java.util.Arrays.fill(low, Double.POSITIVE_INFINITY);
        }

        /* Weaker links than this change nothing that is told, if the strongest one is of so much. */
        double limit(int i, double strongest) {
            return Math.max(floor, served[i] < most ? Math.min(threshold, strongest) : strongest);
        }

        /* Whether the limit may have changed. */
        boolean add(int i, Object id, boolean isOld, double s, double length, boolean free) {
            boolean changed = s > best[i] || s >= threshold && served[i] < most || isOld && s > old[i];
            if (s > best[i] || s == best[i] && ((Comparable) id).compareTo(server[i]) < 0) {
                best[i] = s; server[i] = id; far[i] = length; los[i] = free;
            }
            if (s < low[i]) low[i] = s;
            if (isOld && s > old[i]) old[i] = s;
            links[i]++;
            if (s >= threshold) served[i]++;
            return changed;
        }

        Row row(int i) {
            Object before = Double.isInfinite(old[i]) ? null : (Object) Double.valueOf(old[i]);
            return RowFactory.create(new Object[] {ids.get(i), Double.valueOf(best[i]), server[i], Boolean.valueOf(los[i]), Double.valueOf(far[i]), Long.valueOf(links[i]), Long.valueOf(most < 0 ? served[i] : Math.min(served[i], most)), Double.valueOf(low[i]), before});
        }
    }

    /* The records of a transmitter, which are published strongest first (ties: smaller cell). */
    static final class Records implements java.util.Comparator {
        int size = 0;
        double[] rsrp = new double[256];
        long[] cell = new long[256];
        int[] rest = new int[256];

        void add(long id, double s, double diff, double clut, boolean los) {
            if (size == cell.length) {
                rsrp = java.util.Arrays.copyOf(rsrp, 2 * size); cell = java.util.Arrays.copyOf(cell, 2 * size); rest = java.util.Arrays.copyOf(rest, 2 * size);
            }
            rsrp[size] = s; cell[size] = id;
            rest[size++] = (whole(s, -128, 127) & 255) | whole(diff, 0, 255) << 8 | whole(clut, 0, 255) << 16 | (los ? 1 : 0) << 24;
        }

        static int whole(double x, int low, int high) { return (int) Math.max((double) low, Math.min((double) high, Math.rint(x))); }

        public int compare(Object a, Object b) {
            int i = ((Integer) a).intValue(), j = ((Integer) b).intValue();
            int c = Double.compare(rsrp[j], rsrp[i]);
            return c != 0 ? c : Long.compareUnsigned(cell[i] ^ Long.MIN_VALUE, cell[j] ^ Long.MIN_VALUE);
        }

        byte[] blob() {
            Integer[] order = new Integer[size];
            for (int i = 0; i < size; i++) order[i] = Integer.valueOf(i);
            java.util.Arrays.sort(order, this);
            java.nio.ByteBuffer out = java.nio.ByteBuffer.allocate(12 * size).order(java.nio.ByteOrder.LITTLE_ENDIAN);
            for (int i = 0; i < size; i++) {
                int a = order[i].intValue();
                out.putLong(cell[a]);
                out.putInt(rest[a]);
            }
            return out.array();
        }
    }

    /* Of all packed rows with the same transmitters. */
    final class Pack {
        final Object[] key;
        final List ids;
        final Records[] records;

        Pack(Unit u) {
            key = u.key; ids = u.txIds;
            records = new Records[ids.size()];
            for (int j = 0; j < records.length; j++) records[j] = new Records();
        }

        void add(Unit u) {
            long[] cells = new long[u.rxIds.size()];
            for (int i = 0; i < cells.length; i++) cells[i] = ((Number) u.rxIds.get(i)).longValue();
            for (int a = 0; a < u.size; a++) records[u.t[a]].add(cells[u.r[a]], u.rsrp[a], u.diff[a], u.clutter[u.r[a]], u.los[a]);
        }
    }

    final class Rows implements Iterator {
        Pack pack, whole;

        final Iterator in;
        Unit unit;
        Best best, done;
        int at = 0;
        long[] count, served;
        double[] sum;
        Object next;

        Rows(Iterator in) { this.in = in; }

        public boolean hasNext() {
            if (next == null) next = mode == LINKS ? link() : mode == RECEIVERS ? receiver() : mode == TRANSMITTERS ? transmitter() : footprint();
            return next != null;
        }

        public Object next() {
            if (!hasNext()) throw new java.util.NoSuchElementException();
            Object out = next;
            next = null;
            return out;
        }

        public void remove() { throw new UnsupportedOperationException(); }

        Unit unit() {
            Row row = (Row) in.next();
            return new Unit(row, keyOf(row), null);
        }

        Object link() {
            while (unit == null || at == unit.size) {
                if (!in.hasNext()) return null;
                unit = unit();
                at = 0;
            }
            int a = at++;
            return RowFactory.create(new Object[] {unit.txIds.get(unit.t[a]), unit.rxIds.get(unit.r[a]), Double.valueOf(unit.rsrp[a]), Double.valueOf(unit.path[a]), Double.valueOf(unit.diff[a]), Double.valueOf(unit.clutter[unit.r[a]]), Double.valueOf(unit.far[a]), Boolean.valueOf(unit.los[a])});
        }

        Object receiver() {
            while (true) {
                if (done != null) {
                    while (at < done.links.length) {
                        int i = at++;
                        if (done.links[i] > 0) return done.row(i);
                    }
                    done = null;
                }
                if (!in.hasNext()) {
                    if (best == null) return null;
                    done = best; best = null; at = 0;
                    continue;
                }
                Row row = (Row) in.next();
                Object[] key = keyOf(row);
                if (best == null || !java.util.Arrays.equals(best.key, key)) {
                    done = best; at = 0;
                    best = new Best(row, key);
                }
                new Unit(row, key, best);
            }
        }

        Object footprint() {
            while (true) {
                if (whole != null) {
                    while (at < whole.records.length) {
                        int j = at++;
                        Records got = whole.records[j];
                        whole.records[j] = null;
                        if (got.size > 0) return RowFactory.create(new Object[] {whole.ids.get(j), Long.valueOf(got.size), got.blob()});
                    }
                    whole = null;
                }
                if (!in.hasNext()) {
                    if (pack == null) return null;
                    whole = pack; pack = null; at = 0;
                    continue;
                }
                Unit u = unit();
                if (pack == null || !java.util.Arrays.equals(pack.key, u.key)) {
                    whole = pack; at = 0;
                    pack = new Pack(u);
                }
                pack.add(u);
            }
        }

        Object transmitter() {
            while (true) {
                if (unit != null) {
                    while (at < count.length) {
                        int j = at++;
                        if (count[j] > 0) return RowFactory.create(new Object[] {unit.txIds.get(j), Long.valueOf(count[j]), Long.valueOf(served[j]), Double.valueOf(sum[j])});
                    }
                }
                if (!in.hasNext()) return null;
                unit = unit();
                double[] w = numbers(unit.row, "r_" + weight);
                int m = unit.txIds.size();
                count = new long[m]; served = new long[m]; sum = new double[m]; at = 0;
                for (int a = 0; a < unit.size; a++) {
                    int j = unit.t[a];
                    count[j]++;
                    if (unit.rsrp[a] >= threshold) {
                        served[j]++;
                        double add = w[unit.r[a]];
                        if (!Double.isNaN(add)) sum[j] += Math.max(-Double.MAX_VALUE, Math.min(Double.MAX_VALUE, add));
                    }
                }
            }
        }
    }

    public Iterator call(Iterator in) {
        if (f == null) shares();
        return new Rows(in);
    }
}
"""

#: The loops by the JVM's vectors, where it has their module (as Spark starts it), step by step the same. A quotient by the cell is its product with the reciprocal, put right
#: by the exact remainder, which is the division's own result; numbers are rounded by adding what leaves no room for a fraction.
LANES = r"""
package ridgecast;

import jdk.incubator.vector.DoubleVector;
import jdk.incubator.vector.VectorOperators;
import jdk.incubator.vector.VectorSpecies;

public class Lanes extends Loops {
    static final VectorSpecies S = DoubleVector.SPECIES_PREFERRED;
    static final int W = S.length();
    static final double ROUND = 6755399441055744.0;

    public Lanes() { if (8 % W != 0) throw new UnsupportedOperationException(); }

    public double rise(double[] f, double[] square, double[] weight, double[] e, double[] v, int first, int last, double dx, double x, double x0, double dy, double y, double y0, double cell, double curve, double a, double b) {
        DoubleVector most = DoubleVector.broadcast(S, Double.NEGATIVE_INFINITY), less = DoubleVector.broadcast(S, -cell), part = DoubleVector.broadcast(S, 1.0 / cell);
        DoubleVector round = DoubleVector.broadcast(S, ROUND), period = DoubleVector.broadcast(S, 200.0), high = DoubleVector.broadcast(S, 300.0), top = DoubleVector.broadcast(S, y0);
        for (int i = first; i < last; i += W) {
            DoubleVector g = DoubleVector.fromArray(S, f, i);
            DoubleVector p = g.mul(dx).add(x).sub(x0), q = top.sub(g.mul(dy).add(y)), c = p.mul(part), r = q.mul(part);
            c = c.fma(less, p).fma(part, c).add(round).sub(round);
            r = r.fma(less, q).fma(part, r).add(round).sub(round);
            DoubleVector t = c.mul(7.0).add(r.mul(3.0));
            DoubleVector h = high.sub(t.sub(t.mul(1.0 / 200.0).add(round).sub(round).mul(period)).abs()).sub(DoubleVector.fromArray(S, square, i).mul(curve));
            h.intoArray(e, i);
            h = h.sub(g.mul(b).add(a)).mul(DoubleVector.fromArray(S, weight, i));
            h.intoArray(v, i);
            most = most.max(h);
        }
        return most.reduceLanes(VectorOperators.MAX);
    }

    public double over(double[] f, double[] weight, double[] e, double[] v, int first, int last, double a, double b) {
        DoubleVector most = DoubleVector.broadcast(S, Double.NEGATIVE_INFINITY);
        for (int i = first; i < last; i += W) most = most.max(DoubleVector.fromArray(S, e, i).sub(DoubleVector.fromArray(S, f, i).mul(b).add(a)).mul(DoubleVector.fromArray(S, weight, i)));
        return most.reduceLanes(VectorOperators.MAX);
    }
}
"""

LINKS, RECEIVERS, TRANSMITTERS, FOOTPRINTS = 0, 1, 2, 3

#: Of each JVM gateway: the compiled class.
_LOADED = weakref.WeakKeyDictionary()


def _build(jvm):
    """(class loader, code by class name) of the sources."""
    loader, code = jvm.java.lang.Thread.currentThread().getContextClassLoader(), {}
    for source in (SOURCE, LANES):
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(loader)
        try:
            compiler.cook(source)
        except Py4JJavaError:
            if source is LANES:
                break  # no such module on the driver: plain loops
            raise
        loader = compiler.getClassLoader()
        code |= dict(compiler.getBytecodes())
    return loader, code


def _compiled(spark):
    """The class on the driver, after its jar was added to the session's context."""
    context = spark.sparkContext
    if context not in _LOADED:
        loader, code = _build(context._jvm)
        folder = tempfile.TemporaryDirectory(prefix="ridgecast-")
        path = os.path.join(folder.name, "ridgecast-links.jar")
        with zipfile.ZipFile(path, "w") as z:
            for name, data in code.items():
                z.writestr(name.replace(".", "/") + ".class", bytes(data))
        context._jsc.sc().addJar(path)
        _LOADED[context] = loader.loadClass("ridgecast.Links"), folder
    return _LOADED[context][0]


def knows(terrain) -> bool:
    return type(terrain) is kernel.FormulaTerrain


def run(met: DataFrame, schema: str, mode: int, terrain, tx: str, rx: str, radio: Radio, floor: float, weight: str = "", prefix: str = "", most: int = -1) -> DataFrame:
    """``met``'s links (rows, or added up by receiver or by transmitter) in the columns of ``schema``; ``most`` as for ``blocks.per_receiver``, -1 for all."""
    spark = met.sparkSession
    jvm = spark.sparkContext._jvm
    made = _compiled(spark).getConstructors()[0]
    lists = []
    q = (radio.freq_mhz, radio.eirp_dbm, radio.subcarriers, radio.shadow_margin_db, radio.rx_height_m, radio.k_factor, radio.max_link_m, floor, radio.threshold_dbm, kernel.EARTH_M, kernel.LIGHT_M_S)
    for values in (q, (terrain.x0, terrain.y0, terrain.cell_m, terrain.rows, terrain.cols)):
        lists.append(jvm.java.util.ArrayList())
        for x in values:
            lists[-1].add(float(x))
    given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 9)
    for i, x in enumerate((mode, tx, rx, weight, prefix, radio.samples, most, *lists)):
        given[i] = x
    f = made.newInstance(given)
    kind = jvm.org.apache.spark.sql.types.StructType.fromDDL(schema)
    out = met._jdf.mapPartitions(f, jvm.org.apache.spark.sql.Encoders.row(kind)).toDF()
    return type(met)(out, spark)
