"""Rule sets of customers and sellers."""

from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.parsing import number, timestamp
from ..operators.validate import DUPLICATE, Rule, RuleSet
from . import schemas, vocabulary as v


def customers(as_of=v.AS_OF, duplicates: str = "later", null_keys: str = "distinct") -> RuleSet:
    c = F.col
    born, registered = c("_born"), c("_registered")
    return RuleSet(
        entity="customers",
        key="customer_id",
        columns=schemas.CUSTOMERS,
        duplicates=duplicates,
        null_keys=null_keys,
        derived={"_born": timestamp(c("date_of_birth")), "_registered": timestamp(c("registration_date"))},
        rules=(
            Rule("missing_customer_id", p.blank(c("customer_id"))),
            Rule("duplicate_customer_id", c(DUPLICATE)),
            Rule("missing_first_name", p.blank(c("first_name"))),
            Rule("missing_last_name", p.blank(c("last_name"))),
            Rule("invalid_gender", p.not_in(c("gender"), v.GENDERS)),
            Rule("invalid_date_of_birth", p.unparseable(born)),
            Rule("future_date_of_birth", p.in_future(born, as_of)),
            Rule("invalid_email", p.not_matching(c("email"), v.EMAIL)),
            Rule("invalid_phone", p.not_matching(c("phone"), v.MOBILE)),
            Rule("missing_city", p.blank(c("city"))),
            Rule("missing_state", p.blank(c("state"))),
            Rule("invalid_country", p.not_equal(c("country"), v.COUNTRY)),
            Rule("invalid_postal_code", p.not_matching(c("postal_code"), v.POSTAL_CODE)),
            Rule("invalid_registration_date", p.unparseable(registered)),
            Rule("future_registration_date", p.in_future(registered, as_of)),
            Rule("invalid_loyalty_tier", p.not_in(c("loyalty_tier"), v.LOYALTY_TIERS)),
            Rule("invalid_customer_status", p.not_in(c("customer_status"), v.PARTY_STATUSES)),
        ),
    )


def sellers(as_of=v.AS_OF, duplicates: str = "later", null_keys: str = "distinct") -> RuleSet:
    c = F.col
    joined = c("_joined")
    return RuleSet(
        entity="sellers",
        key="seller_id",
        columns=schemas.SELLERS,
        duplicates=duplicates,
        null_keys=null_keys,
        derived={"_joined": timestamp(c("joined_date")), "_rating": number(c("seller_rating"))},
        rules=(
            Rule("missing_seller_id", p.blank(c("seller_id"))),
            Rule("duplicate_seller_id", c(DUPLICATE)),
            Rule("missing_seller_name", p.blank(c("seller_name"))),
            Rule("invalid_email", p.not_matching(c("email"), v.EMAIL)),
            Rule("invalid_phone", p.not_matching(c("phone"), v.MOBILE)),
            Rule("missing_city", p.blank(c("city"))),
            Rule("missing_state", p.blank(c("state"))),
            Rule("invalid_country", p.not_equal(c("country"), v.COUNTRY)),
            Rule("invalid_seller_rating", p.out_of_range(c("_rating"), low=1, high=5)),
            Rule("invalid_seller_status", p.not_in(c("seller_status"), v.PARTY_STATUSES)),
            Rule("invalid_joined_date", p.unparseable(joined)),
            Rule("future_joined_date", p.in_future(joined, as_of)),
        ),
    )
