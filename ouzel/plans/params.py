"""Parameters of the standard views (PO, PE, EV) used by the registered queries."""

# Parameters of the standard views.
PO_D = 1.0        # distance for points from orders
PO_M = 3          # outlier threshold
TOP_K = 9         # rows of the top-k reports
PE_D = 0.05       # distance for points from embeddings
PE_M = 3
PEC_D = 1.15      # distance for all columns of the embeddings
PEC_M = 2
PE_K = 5          # centers
PE_L = 4          # buckets (b = id mod L)
PE_FFT_M = 40     # outlier threshold when the clustering radius is the distance
EV_PHI = 0.015
EV_EPSILON = 0.01
EV_DELTA = 0.1
EV_SEED = 42
PREFIX_NUM, PREFIX_DEN = 4, 5   # n = rows * 4 // 5 where the prefix is the feature
ORD_K = 100       # centers for the points from orders
ORD_L = 16        # their buckets
