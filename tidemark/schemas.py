"""Record schemas of the two systems (movie recommender, order warehouse)."""

from pyspark.sql import types as T

_CODES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "string": T.StringType(),
}


def _struct(spec: str) -> T.StructType:
    fields = (part.split(":") for part in spec.split())
    return T.StructType([T.StructField(name, _CODES[code]) for name, code in fields])


# recommender
MOVIE = _struct(
    "mid:int name:string descri:string timelong:string issue:string shoot:string "
    "language:string genres:string actors:string directors:string"
)
RATING = _struct("uid:int mid:int score:double timestamp:int")
TAG = _struct("uid:int mid:int tag:string timestamp:int")
RECOMMENDATION = _struct("mid:int score:double")
GENRE_RECS = T.StructType(
    [T.StructField("genres", T.StringType()), T.StructField("recs", T.ArrayType(RECOMMENDATION))]
)
USER_RECS = T.StructType(
    [T.StructField("uid", T.IntegerType()), T.StructField("recs", T.ArrayType(RECOMMENDATION))]
)
MOVIE_RECS = T.StructType(
    [T.StructField("mid", T.IntegerType()), T.StructField("recs", T.ArrayType(RECOMMENDATION))]
)

# warehouse facts
ORDER_INFO = _struct(
    "id:long province_id:long order_status:string user_id:long final_total_amount:double "
    "benefit_reduce_amount:double original_total_amount:double feight_fee:double "
    "expire_time:string create_time:string operate_time:string"
)
ORDER_DETAIL = _struct(
    "id:long order_id:long sku_id:long order_price:double sku_num:long sku_name:string "
    "create_time:string"
)
ORDER_WIDE = _struct(
    "order_detail_id:long order_id:long order_status:string create_time:string user_id:long "
    "sku_id:long sku_price:double sku_num:long sku_name:string benefit_reduce_amount:double "
    "feight_fee:double original_total_amount:double final_total_amount:double "
    "final_detail_amount:double if_first_order:string province_name:string "
    "province_area_code:string user_age_group:string user_gender:string dt:string spu_id:long "
    "tm_id:long category3_id:long spu_name:string tm_name:string category3_name:string"
)
DAU = _struct("mid:string uid:string ar:string ch:string vc:string dt:string hr:string mi:string ts:long")

# warehouse dimensions
PROVINCE = _struct("id:string name:string area_code:string iso_code:string")
SKU = _struct(
    "id:string spu_id:string price:string sku_name:string tm_id:string category3_id:string "
    "create_time:string category3_name:string spu_name:string tm_name:string"
)
SPU = _struct("id:string spu_name:string")
TRADEMARK = _struct("tm_id:string tm_name:string")
CATEGORY3 = _struct("id:string name:string category2_id:string")
USER = _struct("id:string user_level:string birthday:string gender:string")
USER_STATUS = _struct("user_id:string if_consumed:string")
TRADEMARK_STAT = _struct("stat_time:string trademark_id:long trademark_name:string amount:double")

# traffic logs and search documents
APP_LOG = T.StructType(
    [
        T.StructField("common", _struct("mid:string uid:string ar:string ch:string vc:string")),
        T.StructField("start", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)
SEARCH_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("doubanScore", T.FloatType()),
        T.StructField("actorList", T.ArrayType(_struct("id:long name:string"))),
    ]
)


def extend(schema: T.StructType, spec: str) -> T.StructType:
    """A schema with more fields, given as "name:type name:type"."""
    return T.StructType([*schema.fields, *_struct(spec).fields])
