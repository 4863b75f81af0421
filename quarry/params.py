"""Default parameters of the stages, dotted-path overrides and their hash."""

from __future__ import annotations

import copy
import hashlib

from quarry.functions.canonical import canonical_json

#: Defaults that results depend on.
DEFAULTS: dict = {
    "head_box": {"lateral_m": 0.5, "up_m": 0.2, "down_m": 1.0},
    "camera_height_m": 1.6,
    "min_content_m": 6.0,
    "s0": {"nadir_pitch_deg": -70.0, "edge_magnitude": 0.15, "edge_density_max": 0.10, "dilate_px": 12, "score_min": 0.5, "views": 8, "fov_deg": 90.0, "cap_fov_deg": 100.0, "view_px": 640},
    "s1": {"delta_max": 2},
    "s2": {"ring": 8, "fov_deg": 100.0, "min_weight": 0.02, "sky_percentile": 0.9, "sky_grad_max": 0.02, "guided_radius": 8, "guided_eps": 1e-4, "huber_delta": 0.15, "huber_iters": 8, "affine_reg": 1e-3, "anchor": 1e6, "step_max_log": 0.60, "range_min": 2.0},
    "s2b": {"cone_pitch_deg": -45.0, "irls_iters": 20, "tilt_max_deg": 15.0, "residual_max": 0.15, "band_up_deg": 20.0, "band_down_deg": 5.0, "near_percentile": 0.02},
    "s3": {"log_grad_min": 0.30, "ratio_min": 1.4, "band_extra_px": 2, "band_px_max": 64, "pyramid_min": 4, "bg_max_frac": 0.05},
    "s4": {"base_stride": 2, "edge_boost": 4.0, "ground_boost": 2.0, "ground_pitch_deg": -20.0, "scale_multiplier": 1.15, "flatten": 0.15, "shell_radius_m": 200.0, "shell_m": 50.0, "feather_m": 5.0, "shell_stride": 4, "fg_opacity": 0.98, "bg_opacity": 0.95, "shell_opacity": 0.995, "var_boost": 3.0, "var_window_px": 3, "var_ref": 0.04},
    "s6": {"opacity_floor": 0.05, "knn_k": 4, "isolation_factor": 8.0, "merge_factor": 0.25, "retries": 6, "retry_factor": 1.5, "primary": "quest", "cap": 1_000_000, "sog_max_mb": 60, "other_caps": {"review": 2_000_000}},
    "s7": {"render_px": 512, "fov_deg": 90.0, "squat_y_m": -0.9, "hole_max_frac": 0.005, "blob_max_px": 400, "center_frac": 0.33, "jitter_m": 0.001, "jitter_max": 0.02, "ipd_m": 0.063, "vdisp_max_px": 0.5, "near_min_m": 0.75, "order_min": 0.98, "people_score_min": 0.5, "tiles_lon": 8, "tiles_lat": 4, "ssim_worst_min": 0.30, "ssim_mean_min": 0.55},
}


def with_overrides(params: dict, overrides: dict[str, object]) -> dict:
    """A copy with values at dotted paths replaced; KeyError for a path that isn't there."""
    out = copy.deepcopy(params)
    for path, value in overrides.items():
        *parents, last = path.split(".")
        at = out
        for p in parents:
            at = at[p]
        if not isinstance(at, dict) or last not in at:
            raise KeyError(path)
        at[last] = value
    return out


def params_hash(params: dict) -> str:
    return hashlib.sha256(canonical_json(params)).hexdigest()
