"""The normal distribution as column expressions."""

from functools import reduce

from pyspark.sql import functions as F

# Hart's rational approximation of the normal distribution function
# (numerator and denominator, highest power first).
CDF_UPPER = (3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
CDF_LOWER = (8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
# Wichura's approximation AS 241 of its inverse, for the middle, the
# sides and the far tails (numerators and denominators, highest power first).
MIDDLE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
SIDE = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258, 3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0),
)
TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def _polynomial(coefficients, x):
    return reduce(lambda total, c: total * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def normal_cdf(z):
    """The share of a standard normal distribution below a double column."""
    size = F.abs(z)
    bell = F.exp(-size * size / 2)
    near = bell * _polynomial(CDF_UPPER, size) / _polynomial(CDF_LOWER, size)
    far = reduce(lambda rest, k: size + F.lit(float(k)) / rest, (4, 3, 2, 1), size + F.lit(0.65))
    tail = F.when(size < 7.07106781186547, near).otherwise(bell / far / 2.506628274631)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def normal_quantile(p):
    """Where a standard normal distribution has the share ``p`` (0 < p < 1) below; else null."""
    q = p - 0.5
    r = F.lit(0.180625) - q * q
    middle = q * _polynomial(MIDDLE[0], r) / _polynomial(MIDDLE[1], r)
    depth = F.sqrt(-F.log(F.least(p, 1 - p)))
    side = _polynomial(SIDE[0], depth - 1.6) / _polynomial(SIDE[1], depth - 1.6)
    tail = _polynomial(TAIL[0], depth - 5) / _polynomial(TAIL[1], depth - 5)
    outer = F.signum(q) * F.when(depth <= 5, side).otherwise(tail)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, middle).otherwise(outer))
