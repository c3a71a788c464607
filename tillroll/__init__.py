"""tillroll: retail purchase analytics and coupon selection as lazy Spark plans."""

__version__ = "0.1.0"
