"""Clustering of points at scale, as Spark DataFrame programs."""

import sys

from pyspark import cloudpickle

from .operators.components import connected_components
from .operators.evaluate import (
    cluster_sizes,
    compare_centroids,
    distinct_clusters,
    in_top_clusters,
    inertia,
    join_labels,
    label_overlap,
    noise_summary,
    run_metrics,
    silhouette_euclid,
    silhouette_sq,
    top_clusters,
    without_noise,
)
from .operators.nearest import assign_nearest, centroid_distances
from .operators.neighbors import eps_neighbors, grid_cells
from .operators.prepare import (
    assemble,
    filter_box,
    fit_minmax,
    inverse_scale,
    scale,
    with_hour,
)
from .operators.sample import limit_points, raw_limit, seeded_sample
from .plans.boundedsilhouette import silhouette_euclid_all
from .plans.boxtree import tree_kmeans
from .plans.dbscan import (
    dbscan,
    dbscan_border,
    dbscan_core,
    dbscan_local_labels,
    dbscan_memberships,
)
from .plans.elkan import elkan_init, elkan_kmeans, elkan_step
from .plans.kmeans import kmeans
from .plans.scoring import predict_nearest, preprocess, preprocess_to

# Functions that run inside tasks travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
