"""Buyer table with a planted signal, made from row ids alone."""

from pyspark.sql import functions as F


def u(name):
    digits = F.substring(F.md5(F.concat(F.lit(f"{name}:"), F.col("id").cast("string"))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / 4294967296.0


def pick(name, levels):
    return F.element_at(F.array(*[F.lit(x) for x in levels]), (1 + F.floor(u(name) * len(levels))).cast("int"))


def whole(name, low, high):
    return (low + F.floor(u(name) * (high - low + 1))).cast("long")


def buyers(spark, n, start=0, intercept=-9.7):
    concern, income = 1 + F.floor(5 * u("concern")), 30000 + 158549 * u("income")
    order, subsidised = F.floor(3 * u("anxiety")), (u("subsidy") < 0.6)
    pull = intercept + 4 * subsidised.cast("int") + 2 * order + 1.6 * (concern - 3) + (income - 85000) / 20000
    return spark.range(start, start + n).select(
        "id", whole("age", 25, 69).alias("Age"), F.round(income, 2).alias("Annual_Income_USD"),
        F.round(5 + 93.7 * u("commute"), 1).alias("Daily_Commute_km"), whole("cars", 1, 4).alias("Number_of_Cars_Owned"),
        whole("home", 0, 14).alias("Charging_Stations_Near_Home"), whole("work", 0, 19).alias("Charging_Stations_Near_Work"),
        concern.cast("double").alias("Environmental_Concern_Level"), pick("gender", ["Female", "Male", "Other"]).alias("Gender"),
        pick("city", ["Rural", "Suburban", "Urban"]).alias("City_Type"),
        pick("car", ["Hatchback", "Sedan", "SUV", "Truck"]).alias("Current_Car_Type"),
        pick("charging", ["No", "Yes"]).alias("Home_Charging_Possible"),
        F.when(subsidised, "Yes").otherwise("No").alias("Subsidy_Available"),
        F.when(order == 0, "High").when(order == 1, "Medium").otherwise("Low").alias("Range_Anxiety_Level"),
        F.when(u("target") < 1 / (1 + F.exp(-pull)), "Yes").otherwise("No").alias("Will_Buy_EV"))
