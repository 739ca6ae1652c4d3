"""Canonical columns, units and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

NM_PER_UM = 1000.0

# Divisors turning soma metadata voxels into micrometres.
META_SOMA_DIVISOR = (250.0, 250.0, 25.0)

# Voxel edge lengths in nanometres.
VOXEL_NM = (4.0, 4.0, 40.0)

# Node type codes.
UNLABELED, SOMA, PRE_ONLY, POST_ONLY, MIXED, BRANCH, TERMINAL = 0, 1, 2, 3, 4, 5, 6

NODE_SCHEMA = T.StructType(
    [
        T.StructField("neuron", T.StringType()),
        T.StructField("row_idx", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("type", T.IntegerType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("z", T.DoubleType()),
        T.StructField("radius", T.DoubleType()),
        T.StructField("parent", T.LongType()),
    ]
)

# Brain regions by group, in display order.
NEUROPIL_GROUPS = (
    ("Optic Lobe", ("ME", "LOP", "LO", "AME", "LA", "OCG")),
    ("Lateral Complex", ("LAL", "BU", "GA")),
    ("Superior Protocerebrum", ("SMP", "SIP", "SLP")),
    ("Inferior Protocerebrum", ("ATL", "CRE", "SCL", "ICL", "IB")),
    ("Ventromedial", ("VES", "SPS", "IPS", "EPA", "GOR")),
    ("Ventrolateral", ("AOTU", "AVLP", "PVLP", "PLP", "WED")),
    ("Central Complex", ("EB", "FB", "PB", "NO")),
    ("Mushroom Body", ("MB_VL", "MB_ML", "MB_PED", "MB_CA")),
    ("Antennal Lobe", ("AL",)),
    ("Lateral Horn", ("LH",)),
    ("Periesophageal", ("FLA", "CAN", "PRW", "SAD", "AMMC")),
    ("Gnathal Ganglia", ("GNG",)),
)
NEUROPIL_GROUP_OF = {name: group for group, names in NEUROPIL_GROUPS for name in names}
NEUROPIL_ORDER = tuple(name for _, names in NEUROPIL_GROUPS for name in names)
